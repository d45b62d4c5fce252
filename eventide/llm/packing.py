"""Packing token sequences with balanced attention cost.

Every document becomes subword ids and an end id. Spark deals the
documents; each task packs them in batches of about ``batch_tokens`` ids, so
nothing is shuffled and a batch bounds the memory. In a batch, ids fill
sequences exactly: as many of ``length`` ids as the batch holds, and shorter
ones, each a power of two, for what is left, so no padding is needed. Documents
are cut at ``length`` ids; the parts are placed in descending order, each into
the sequence of lowest cost (linear + quadratic in the parts' lengths) that has
room for it. When none has, the part is cut to the largest room left and its rest
is placed next.
"""

from __future__ import annotations

import base64
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import map_arrow, per_process, table, text_column

LENGTH, END_ID, BATCH_TOKENS = 2048, 1, 1 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary(name: str = "byte_bpe_50k", path: str | None = None) -> tuple[str, bytes]:
    """Pattern and rank file of a byte-level BPE vocabulary. The file is read
    on the driver (1 MB) and travels with the tasks. With ``added_tokens`` the ids are
    those of the ``tokenizers`` file of the same name; this form encodes five times faster."""
    import public_tokenizers as P
    with open(path or P.path(f"{name}.tiktoken"), "rb") as f:
        return P.PATTERN, f.read()


def added_tokens(name: str = "byte_bpe_50k", path: str | None = None) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file, which it finds in any text."""
    import public_tokenizers as P
    with open(path or P.path(f"{name}.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def encoder(vocab: tuple[str, bytes], added: dict[str, int] | None = None):
    """The encoder of a vocabulary, built once per Python worker. Its ``encode_ordinary``
    takes no notice of ``added`` tokens."""
    import tiktoken

    def build():
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocab[1].splitlines())}
        return tiktoken.Encoding("ranks", pat_str=vocab[0], mergeable_ranks=ranks, special_tokens=added or {})
    return per_process(("encoder", zlib.crc32(vocab[1]), vocab[0], tuple(sorted((added or {}).items()))), build)


def capacities(total: int, length: int) -> np.ndarray:
    """Sequence lengths that ``total`` ids fill exactly."""
    full, rest = divmod(total, length)
    return np.array([length] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1], np.int64)


def place(sizes: np.ndarray, length: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of
    the given sizes; see the module's text."""
    room = capacities(int(sizes.sum()), length)
    cost, used, out = np.zeros(len(room)), np.zeros(len(room), np.int64), []
    parts = [(min(length, n - a), d, a) for d, n in enumerate(sizes.tolist()) for a in range(0, n, length)]
    parts.sort(key=lambda x: (-x[0], x[1], x[2]))
    for n, d, a in parts:
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                s, take = int(fits[np.argmin(cost[fits])]), n
            else:
                s = int(np.argmax(room))
                take = int(room[s])
            out.append((d, a, take, s, int(used[s])))
            room[s] -= take
            used[s] += take
            cost[s] += linear * take + quadratic * take * take
            a, n = a + take, n - take
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: tuple[str, bytes] | None = None,
         length: int = LENGTH, end_id: int = END_ID, batch_tokens: int = BATCH_TOKENS,
         linear: float = 1.0, quadratic: float = 1.0 / LENGTH,
         added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: ``doc_id``, its place ``start`` in the document's
    ids, ``length``, ``ids_crc32`` of its ids as little-endian unsigned 32-bit
    values, the document's ``doc_tokens``, and its ``sequence_id`` and
    ``offset`` there.

    Where a text holds an ``added`` token, it becomes that one id; without any
    given, such text is encoded like other text. A null or empty text is its end id alone. Equal rows are documents of their
    own; other columns are not read. Each id lies in exactly one piece. A
    sequence id names the task and the sequence in it, so a task run again
    after a lost executor gives the same rows.
    """
    vocab = vocab or vocabulary()

    def run(batches):
        from pyspark import TaskContext
        enc = encoder(vocab, added)
        made = TaskContext.get().partitionId() << 33
        ids_of, names, held = [], [], 0

        def flush():
            nonlocal made
            pieces = place(np.array([len(x) for x in ids_of], np.int64), length, linear, quadratic)
            rows = [(names[d], a, n, zlib.crc32(ids_of[d][a:a + n]), len(ids_of[d]), made + s, o) for d, a, n, s, o in pieces]
            made += 1 + max((p[3] for p in pieces), default=-1)
            cols = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py(), allowed_special="all") if added else enc.encode_ordinary(text.as_py())
                ids.append(end_id)
                ids_of.append(np.array(ids, "<u4"))
                names.append(name)
                held += len(ids)
                if held >= batch_tokens:
                    yield flush()
                    ids_of, names, held = [], [], 0
        if ids_of:
            yield flush()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(docs, text_col).alias("text")),
                     run, SCHEMA)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), added=added_tokens())

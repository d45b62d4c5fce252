"""Scoring texts with a small causal self-attention language model.

Words (lower-cased, without white space) are spelled by subword ids; an end
id closes a text. One attention layer reads a window of ids and predicts the class
of the next one. Windows overlap: each takes its first ids as context only, so every id
is scored once, in batches with a causal mask. The layer starts from a bounded sample and then
learns from every window of all training texts (see :func:`learned`); the classes come from
the neighbour counts of all of them. Some classes hold the ids that begin a word, the others those that
go on with one. At a word's beginning the model gives the class; within the class
the word follows from corpus counts, discounted by ``DISCOUNT`` each, and
the mass so freed goes to the spelling: class by class through the layer, ids within a class
by corpus counts, and the word's end as the mass of all beginnings. The result
is a probability of the text as a sequence of words.

Each text is spelled once and stored as codes into its slice's different words; counting,
learning and scoring go on from there. Corpus counts are over all training documents, too: tasks count their
words first, Spark adds them up. The words above a count that at most 2^18 words
reach travel with the tasks (a fixed bound); the others, which are rare and thus have no
hot key, meet their counts in an equi-join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import (
    grouped_arrow, joined_hashes, map_arrow, part_sums, per_process, table, text_column, utf8, word_bounds, word_hashes, written,
)
from eventide.llm.packing import encoder, vocabulary
from eventide.llm.toxic_spans import chosen, sample_places, sizes
from eventide.llm.weighted_minhash import slices
from eventide.session import scratch_path

FOLDS, HELD_FOLD = 7, 2
WINDOW, STRIDE, WIDTH, UNITS = 24, 20, 16, 4096
#: Classes: the end alone, word beginnings, and from ``BEGIN`` on what goes on.
BEGIN, CLASSES, DISCOUNT = 48, 96, 0.75
SAMPLE_DOCS, SAMPLE_BYTES, STEPS, BATCH = 3000, 6 << 20, 900, 128
#: Rounds of the pass over all texts, its first rate, and the units of a block of weights.
ROUNDS, RATE, BLOCK = 4, 0.003, 64
HOT_WORDS = 1 << 18
#: Different words whose spelling a worker remembers, and the most ids of one.
REMEMBERED, SHORT = 1 << 18, 16
END = 50256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    unit: np.ndarray       # id -> embedding row
    klass: np.ndarray      # id -> class
    inside: np.ndarray     # id -> ln p(id | class)
    par: dict              # weights of the layer
    mass: np.ndarray       # class -> tokens of its words in the corpus
    kinds: np.ndarray      # class -> different words


FIELDS = ("unit", "klass", "inside", "par", "mass", "kinds")
#: Rows of one matrix product while scoring.
ROWS = 256


def lower_words(texts: pa.Array):
    """Lower-cased bytes of a text column, word bounds, words before each text
    and the words' hashes."""
    data, off = utf8(texts)
    low = _LOWER[data] if len(data) else data
    starts, ends, before = word_bounds(low, off)
    return low, starts, ends, before, word_hashes(low, starts, ends, 9).view(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + length`` of every run, one after another."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


def strings(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    n = ends - starts
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(off), pa.py_buffer(low[ragged(starts, n)].tobytes()))


def spell(words: pa.Array, enc) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of each word (after a space) and where they start. All words
    are encoded in one go: only a word's first id begins with a space."""
    if not len(words):
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    text = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
    ids = np.array(enc.encode_ordinary(" " + text), np.int32)
    return ids, np.append(np.flatnonzero(openings(enc)[ids]), len(ids))


def openings(enc) -> np.ndarray:
    """Whether an id begins with a space."""
    def build():
        opens = np.zeros(END + 1, bool)
        opens[:END] = [enc.decode_single_token_bytes(i)[:1] == b" " for i in range(END)]
        return opens
    return per_process(("openings", enc), build)


def id_sums(enc) -> tuple[np.ndarray, np.ndarray]:
    """What each id adds to the hash of a word (:func:`joined_hashes`), with which words are hashed as in :func:`lower_words`."""
    return part_sums([enc.decode_single_token_bytes(i).removeprefix(b" ") for i in range(END)], 9)


def spellings(own: np.ndarray, words, enc) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each of the different words with hashes ``own``, and their ids laid end to end. Words
    that the worker does not remember are spelled; ``words`` gives those at given places."""
    kept = per_process(("spellings", enc), lambda: [np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.int32)])
    known, known_at, known_ids = kept
    at, up = np.empty(len(own), np.int64), np.argsort(own)
    at[up] = np.searchsorted(known, own[up])
    hit = np.zeros(len(own), bool)
    inside = at < len(known)
    hit[inside] = known[at[inside]] == own[inside]
    miss = np.flatnonzero(~hit)
    ids, new_at = spell(words(miss), enc)
    size, begin = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
    size[hit], begin[hit] = np.diff(known_at)[at[hit]], known_at[at[hit]]
    size[miss], begin[miss] = np.diff(new_at), len(known_ids) + new_at[:-1]
    ids = np.concatenate([known_ids, ids])
    if len(known) < REMEMBERED:
        more = miss[size[miss] <= SHORT][:REMEMBERED - len(known)]
        h = np.concatenate([known, own[more]])
        order = np.argsort(h)
        n, first = (np.concatenate(x)[order] for x in ((np.diff(known_at), size[more]), (known_at[:-1], begin[more])))
        kept[:] = h[order], np.concatenate([[0], np.cumsum(n)]), ids[ragged(first, n)]
    return size, ids[ragged(begin, size)]


def worded(texts: pa.Array, enc):
    """The number of words of each text, the words as places among the different ones of all these texts, and of
    those the hashes, numbers of subword ids, and the ids laid end to end."""
    low, starts, ends, before, h = lower_words(texts)
    kinds = pa.array(h).dictionary_encode()     # by first appearance
    codes, own = kinds.indices.to_numpy(), kinds.dictionary.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
    size, ids = spellings(own, lambda at: strings(low, starts[first[at]], ends[first[at]]), enc)
    return np.diff(before), codes, own, size, ids


def word_counts(ids: DataFrame) -> DataFrame:
    """``(word, h, c)`` of all words of stored texts (:func:`text_ids`), a word as its subword ids of 16 bits; tasks count theirs first."""
    sums = id_sums(encoder(vocabulary()))

    def run(batches):
        held, rows = [], 0

        def merged():
            t = pa.concat_tables(held).group_by(["word", "h"]).aggregate([("c", "sum")])
            return t.select(["word", "h", "c_sum"]).rename_columns(["word", "h", "c"])

        for batch in batches:
            for _, codes, size, sub in _stored_texts(batch):
                h = joined_hashes(*sums, sub, size).view(np.int64)
                off = np.concatenate([[0], 2 * np.cumsum(size)]).astype(np.int32)
                word = pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(off), pa.py_buffer(sub.astype(np.uint16).tobytes())])
                held.append(pa.table({"word": word, "h": h, "c": np.bincount(codes, minlength=len(h))}))
                rows += len(h)
                if rows > 2_000_000:
                    held = [merged()]
                    rows = held[0].num_rows
                    if rows > 1_000_000:
                        yield from held[0].combine_chunks().to_batches()
                        held, rows = [], 0
        if held:
            yield from merged().combine_chunks().to_batches()

    return (map_arrow(ids.select(*STORED), run, "word binary, h long, c long")
            .groupBy("word", "h").agg(F.sum("c").alias("c")))


def windows(lengths: np.ndarray):
    """Windows over texts of ``lengths`` ids laid end to end: start index, text's
    end index, and the first scored place of each window."""
    count = np.where(lengths <= WINDOW, 1, 1 + -(-(lengths - WINDOW) // STRIDE))
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.empty(0, np.int64)
    k = ragged(np.zeros(len(count), np.int64), count)
    return np.repeat(first, count) + k * STRIDE, np.repeat(first + lengths, count), np.where(k > 0, WINDOW - STRIDE, 0)


def forward(par: dict, z: np.ndarray):
    """Class log-probabilities at every place of windows of units ``(batch, WINDOW)``."""
    x = par["E"][z] + par["P"]
    q, k, v = x @ par["Q"], x @ par["K"], x @ par["V"]
    s = q @ k.transpose(0, 2, 1) + par["mask"]
    a = np.exp(s - s.max(axis=2, keepdims=True))
    a /= a.sum(axis=2, keepdims=True)
    o = a @ v
    h = x + o @ par["O"]
    y = h @ par["C"] + par["b"]
    y -= y.max(axis=2, keepdims=True)
    e = np.exp(y)
    total = e.sum(axis=2, keepdims=True)
    return y - np.log(total), (x, q, k, v, a, o, h, e / total)


class Room:
    """The large arrays of a step on up to ``n`` windows, kept from step to step: fresh ones of this size would go
    back to the system every time, which then has to clear them again."""

    def __init__(self, par: dict, n: int):
        (w, d), c, kind = par["P"].shape, par["C"].shape[1], par["Q"].dtype
        new = lambda *s: np.empty(s, kind)
        blocks = -(-n * w // ROWS)
        self.x, self.o, self.more, self.dh = (new(n, w, d) for _ in range(4))
        self.a, self.ds, self.total = new(n, w, w), new(n, w, w), new(n, w, 1)
        self.xt, self.ut, self.t = new(n, d, w), np.ones((n, d + 1, w), kind), new(n, w, d + 1)
        self.pu, self.back = new(n, w, 2 * d), new(n, w, 2 * d)
        self.h, self.hs, self.y = np.ones((blocks, ROWS, d + 1), kind), new(blocks, ROWS, d + 1), new(blocks, ROWS, c)
        self.whole = new(n, w, c)
        self.k, self.rows = new(blocks, ROWS, d), np.zeros(blocks * ROWS, np.int64)
        self.ones = np.ones((max(n, w, c), 1), kind)
        self.cells, self.at = np.arange(par["E"].size).reshape(par["E"].shape), np.empty((n * w, d), np.int64)
        self.E = np.zeros(par["E"].shape, kind)


def attended(par: dict, z: np.ndarray, room: Room, apart: bool = False):
    """The layer up to its hidden values, of which it returns the windows' ``(batch, WINDOW, WIDTH)``. Queries meet keys as
    ``x (Q K') x'`` and values go out as ``x (V O)``: two products for four. Exponents are bounded;
    ``room.a / room.total`` are the weights of attention. ``apart``: a product for each window, as rows of a
    larger one may round by their place."""
    n, w = z.shape
    d = par["Q"].shape[0]
    both = np.concatenate([par["Q"] @ par["K"].T, par["V"] @ par["O"]], axis=1)
    x = np.take(par["E"], z, axis=0, out=room.x[:n], mode="clip")
    x += par["P"]
    if apart:
        pu = np.matmul(x, both, out=room.pu[:n])
    else:
        pu = np.matmul(x.reshape(n * w, d), both, out=room.pu[:n].reshape(n * w, 2 * d)).reshape(n, w, 2 * d)
    np.copyto(room.xt[:n], x.transpose(0, 2, 1))
    a = np.matmul(pu[:, :, :d], room.xt[:n], out=room.a[:n])
    a += par["mask"]
    np.clip(a, -1e30, 60, out=a)
    np.exp(a, out=a)
    total = np.matmul(a, room.ones[:w], out=room.total[:n])
    total += a.dtype.type(1e-30)
    o = np.matmul(a, pu[:, :, d:], out=room.o[:n])
    o /= total
    return np.add(x, o, out=room.more[:n]), both


def exponents(par: dict, hidden: np.ndarray, at: np.ndarray, klass: np.ndarray, room: Room, apart: bool = False):
    """At places ``at`` of the windows, in whole blocks of rows (a product of another shape may round another way): the
    classes' exponents and their sums, the cells and the exponent's logarithm of classes ``klass``. ``apart``: products of
    whole windows, of which the places are taken."""
    blocks, d = -(-len(at) // ROWS), hidden.shape[2]
    rows = room.rows[:blocks * ROWS]
    rows[:len(at)], rows[len(at):] = at, 0
    if apart:
        n, w, c = *hidden.shape[:2], len(par["b"])
        whole = np.matmul(hidden, par["C"], out=room.whole[:n])
        y = room.y[:blocks]
        np.take(whole.reshape(n * w, c), rows, axis=0, out=y.reshape(blocks * ROWS, c), mode="clip")
        y += par["b"]
    else:
        room.h[:blocks, :, :d] = hidden.reshape(-1, d).take(rows, axis=0).reshape(blocks, ROWS, d)
        y = np.matmul(room.h[:blocks], np.concatenate([par["C"], par["b"][None]]), out=room.y[:blocks])
    np.clip(y, -60, 60, out=y)
    cells = np.arange(0, len(at) * y.shape[2], y.shape[2]) + klass
    value = y.reshape(-1).take(cells)
    np.exp(y, out=y)
    return y, cells, value


def gradients(par: dict, z: np.ndarray, target: np.ndarray, scored: np.ndarray, room: Room | None = None):
    """Mean loss at the ``scored`` places of windows ``z`` and its gradients, which hold until ``room`` is used again. Of the
    same value as :func:`forward`'s; exponents are bounded as in :func:`place_scores`."""
    n, w = z.shape
    d = par["Q"].shape[0]
    room = room or Room(par, n)
    hidden, both = attended(par, z, room)
    at = np.flatnonzero(scored)
    y, cells, value = exponents(par, hidden, at, target.ravel()[at], room)
    blocks, count = len(y), max(1, len(at))
    total = y.reshape(blocks * ROWS, y.shape[2]) @ room.ones[:y.shape[2]]
    loss = (np.log(total[:len(at)]).sum() - value.sum()) / count
    y.reshape(-1)[cells] -= total[:len(at), 0]
    scale = 1 / (total * total.dtype.type(count))
    scale[len(at):] = 0
    scale = scale.reshape(blocks, ROWS, 1)
    h = np.multiply(room.h[:blocks], scale, out=room.hs[:blocks])
    of_c = (h.transpose(0, 2, 1) @ y).sum(axis=0)
    g = {"C": of_c[:d], "b": of_c[d]}
    k = np.matmul(y, np.ascontiguousarray(par["C"].T), out=room.k[:blocks])
    k *= scale
    x, o, a, p, u = room.x[:n], room.o[:n], room.a[:n], room.pu[:n, :, :d], room.pu[:n, :, d:]
    dh = room.dh[:n]
    dh.fill(0)
    dh.reshape(n * w, d)[at] = k.reshape(blocks * ROWS, d)[:len(at)]
    # through the weights of attention: the last column takes off each row's mean
    t, ut, ds, back = room.t[:n], room.ut[:n], room.ds[:n], room.back[:n]
    np.divide(dh, room.total[:n], out=t[:, :, :d])
    np.matmul(np.multiply(t[:, :, :d], o, out=hidden), -room.ones[:d], out=t[:, :, d:])
    np.copyto(ut[:, :d], u.transpose(0, 2, 1))
    np.matmul(t, ut, out=ds)
    ds *= a
    np.matmul(ds, x, out=back[:, :, :d])
    np.matmul(a.transpose(0, 2, 1), t[:, :, :d], out=back[:, :, d:])
    of_both = (x.transpose(0, 2, 1) @ back).sum(axis=0)
    of_p, of_u = of_both[:, :d], of_both[:, d:]
    g["Q"], g["K"], g["V"], g["O"] = of_p @ par["K"], of_p.T @ par["Q"], of_u @ par["O"].T, par["V"].T @ of_u
    dx = np.matmul(back.reshape(n * w, 2 * d), np.ascontiguousarray(both.T), out=hidden.reshape(n * w, d))
    dx += dh.reshape(n * w, d)
    dx += np.matmul(ds.transpose(0, 2, 1), p, out=o).reshape(n * w, d)
    g["P"] = (room.ones[:n, 0] @ dx.reshape(n, w * d)).reshape(w, d)
    g["E"] = room.E
    g["E"].fill(0)
    cells = np.take(room.cells, z.ravel(), axis=0, out=room.at[:n * w], mode="clip")
    np.add.at(g["E"].reshape(-1), cells.reshape(-1), dx.reshape(-1))
    return loss, g


class Adam:
    """Adam steps on the weights of a layer, in place: they become parts of one array."""

    def __init__(self, par: dict):
        self.names, self.t = [k for k in par if k != "mask"], 0
        self.flat = np.concatenate([par[k].ravel() for k in self.names])
        for k, x in zip(self.names, np.split(self.flat, np.cumsum([par[k].size for k in self.names])[:-1])):
            par[k] = x.reshape(par[k].shape)
        self.m, self.v, self.g, self.move = (np.zeros_like(self.flat) for _ in range(4))

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        m, v, move = self.m, self.v, self.move
        all_g = np.concatenate([g[k].ravel() for k in self.names], out=self.g)
        m *= 0.9
        m += np.multiply(all_g, 0.1, out=move)
        v *= 0.99
        np.multiply(all_g, 0.01, out=move)
        move *= all_g
        v += move
        np.multiply(v, 1 / (1 - 0.99 ** self.t), out=move)
        np.sqrt(move, out=move)
        move += 1e-7
        np.divide(m, move, out=move)
        move *= rate / (1 - 0.9 ** self.t)
        self.flat -= move


def units_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent ids, and the unit of every id: its place among them, the last one
    for the rest."""
    order = np.argsort(-counts, kind="stable")[:UNITS - 1]
    order = order[counts[order] > 0]
    unit = np.full(len(counts), len(order), np.int32)
    unit[order] = np.arange(len(order))
    return order, unit


#: A slice of texts as :func:`worded` gives it; hashes follow from the ids.
STORED = ("words", "codes", "size", "ids")


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32 in 16 bits each if that holds them; one byte more says that it does not."""
    return x.astype(np.uint16).tobytes() if x.max(initial=0) < 1 << 16 else x.astype(np.uint32).tobytes() + b"\0"


def _unpacked(x: pa.Scalar) -> np.ndarray:
    data = x.as_buffer()
    return np.frombuffer(data, np.uint32, data.size // 4) if data.size % 2 else np.frombuffer(data, np.uint16)


def text_ids(docs: DataFrame, id_col: str = "id", text_col: str = "text", learns: Column | None = None) -> DataFrame:
    """All texts, spelled and stored once: a row per slice of texts with its round (-1 unless the texts are for learning, as
    all are by default), the keys of the texts, and their words (``STORED``)."""
    vocab = vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(vocab)
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for learn in (True, False):
                some = batch.filter(batch.column(2) if learn else pa.compute.invert(batch.column(2)))
                col = some.column(1)
                for a, b in slices(col):
                    words, codes, _, size, ids = worded(col.slice(a, b - a), enc)
                    keys = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), some.column(0).slice(a, b - a))
                    data = [words.astype(np.int64).tobytes(), _packed(codes), _packed(size), ids.astype(np.uint16).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([(part + k) % ROUNDS if learn else -1], pa.int32()), keys]
                                                     + [pa.array([x], pa.binary()) for x in data],
                                                     names=["round", "keys", *STORED])
                    k += learn

    learns = F.lit(True) if learns is None else F.coalesce(learns, F.lit(False))
    numbered = docs.select(F.struct(F.monotonically_increasing_id().alias("r"), F.col(id_col).alias("id")).alias("row"),
                           text_column(docs, text_col).alias("text"), learns.alias("learns"))
    return written(map_arrow(numbered, run, f"round int, keys array<struct<r:long,id:{kind}>>, words binary, codes binary, "
                                            "size binary, ids binary"), "ids")


def _stored_texts(batch: pa.RecordBatch):
    """What is stored of each slice: numbers of words, the words' places among the different ones, and of those the
    numbers of ids and the ids."""
    for words, codes, size, ids in zip(*(batch.column(c) for c in STORED)):
        words, ids = np.frombuffer(words.as_buffer(), np.int64), np.frombuffer(ids.as_buffer(), np.uint16)
        yield words, _unpacked(codes), _unpacked(size).astype(np.int64), ids


def _laid_out(batch: pa.RecordBatch, unit: np.ndarray):
    """Ids, units and numbers of ids of the texts of each slice."""
    for words, codes, size, sub in _stored_texts(batch):
        ids, n, _, _, _ = laid(words, codes, size, sub)
        yield ids, unit[ids], n


def neighbours(ids: DataFrame, order: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """How often each unit follows (left half) and precedes (right half) each of the most
    frequent ones, over all texts. Tasks add up theirs first."""
    m, near = len(order) + 1, min(512, len(order) + 1)

    def run(batches):
        sums = np.zeros(m * 2 * near, np.int64)
        for batch in batches:
            for _, u, n in _laid_out(batch, unit):
                inside = np.ones(len(u) - 1, bool)
                inside[np.cumsum(n)[:-1] - 1] = False    # texts are not neighbours
                left, right = u[:-1][inside].astype(np.int64), u[1:][inside].astype(np.int64)
                at = left < near
                np.add.at(sums, right[at] * (2 * near) + left[at], 1)
                at = right < near
                np.add.at(sums, left[at] * (2 * near) + near + right[at], 1)
        i = np.flatnonzero(sums)
        for a in range(0, len(i), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(i[a:a + (1 << 18)].astype(np.int32)), pa.array(sums[i[a:a + (1 << 18)]])], names=["i", "c"])

    rows = map_arrow(ids.select(*STORED), run, "i int, c long").groupBy("i").agg(F.sum("c").alias("c")).toArrow()
    beside = np.zeros(m * 2 * near)
    beside[rows.column("i").to_numpy()] = rows.column("c").to_numpy()
    return beside.reshape(m, 2 * near)


def classes_of(beside: np.ndarray, order: np.ndarray, opens: np.ndarray, seed: int) -> np.ndarray:
    """Class of every id. Classes gather units with like neighbours (k-means on the
    leading directions of their neighbour counts), ids that open a word apart
    from others; rare ids share the last class of either sort."""
    row, col = beside.sum(axis=1, keepdims=True) + 1, beside.sum(axis=0, keepdims=True) + 1
    pmi = np.log1p(beside * row.sum() / (row * col))
    gram = (pmi * row).T @ pmi
    _, axes = np.linalg.eigh(gram)
    place, weight, rng = pmi @ axes[:, -24:], row[:, 0], np.random.default_rng(seed)
    klass = np.where(opens, BEGIN - 1, CLASSES - 1).astype(np.int32)
    for sort, base, k in ((True, 1, BEGIN - 2), (False, BEGIN, CLASSES - BEGIN - 1)):
        at = np.flatnonzero((opens[order] == sort) & (order != END))
        if not len(at):
            continue
        x, w, k = place[at], weight[at], min(k, len(at))
        centre = x[rng.choice(len(at), k, replace=False, p=w / w.sum())]
        for _ in range(12):
            to = ((x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1)).argmin(axis=1)
            total = np.bincount(to, w, k)
            for d in range(centre.shape[1]):
                centre[:, d] = np.where(total > 0, np.bincount(to, w * x[:, d], k) / np.maximum(total, 1e-9), centre[:, d])
        klass[order[at]] = base + to
    klass[END] = 0
    return klass


def train(texts: list[str], counts: np.ndarray, kinds: np.ndarray, enc, seed: int, beside: np.ndarray, steps: int = STEPS) -> Model:
    """Where the layer's learning starts: steps on windows of a sample's texts. ``beside`` are the
    neighbour counts of the whole corpus, ``counts`` the subword ids' corpus counts over all words, ``kinds`` over different words:
    spelling is for words that are rare or new, which are made like other rare
    words."""
    rng = np.random.default_rng(seed)
    ids, n, _, _ = spelled(pa.array(texts, pa.large_string()), enc)
    order, unit = units_of(counts)
    klass = classes_of(beside, order, openings(enc), seed)
    smooth = kinds + 0.05
    inside = np.log(smooth / np.bincount(klass, smooth, CLASSES)[klass]).astype(np.float32)
    r = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    prior = np.bincount(klass, counts, CLASSES) + 1
    par = {"E": r(int(unit.max()) + 1, WIDTH) * 0 + rng.standard_normal((int(unit.max()) + 1, WIDTH)).astype(np.float32) * 0.3,
           "P": np.zeros((WINDOW, WIDTH), np.float32), "Q": r(WIDTH, WIDTH), "K": r(WIDTH, WIDTH), "V": r(WIDTH, WIDTH),
           "O": r(WIDTH, WIDTH) * np.float32(0.3), "C": r(WIDTH, CLASSES), "b": np.log(prior / prior.sum()).astype(np.float32)}
    par["Q"] /= np.float32(np.sqrt(WIDTH))
    mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
    par["mask"] = mask
    z, end, skip = windows(n)
    units, goals, adam, room = unit[ids], klass[ids], Adam(par), Room(par, BATCH)
    for t in range(1, steps + 1):
        at = rng.integers(0, len(z), BATCH)
        adam.step(gradients(par, *batch_of(units, goals, z[at], end[at], skip[at]), room)[1],
                  0.01 * min(1, t / 50) * (1 - 0.9 * t / steps))
    return Model(unit, klass, inside, par, np.zeros(CLASSES), np.zeros(CLASSES))


def batch_of(units: np.ndarray, goals: np.ndarray, z: np.ndarray, end: np.ndarray, skip: np.ndarray):
    """Units, classes of the next ids and scored places of windows."""
    place, last = z[:, None] + np.arange(WINDOW), end[:, None] - 1
    live = (place < last) & (np.arange(WINDOW) >= skip[:, None])
    return units[np.minimum(place, last)], goals[np.minimum(place + 1, last)], live


def learned(model: Model, ids: DataFrame, seed: int = 1) -> dict:
    """The layer's weights after one pass over every window of all texts, in ``ROUNDS`` rounds. In a round each
    task goes on from the same weights over its texts of the round; the tasks' weights are then
    averaged, block by block: a unit's embedding by how often the tasks met it, the others by the number of ids."""
    sc, par = ids.sparkSession.sparkContext, model.par
    others = [k for k in par if k not in ("E", "mask")]
    ends = np.cumsum([par[k].size for k in others])
    for r in range(ROUNDS):
        share = sc.broadcast((par, model.unit, model.klass))

        def run(batches, r=r, share=share):
            kept, unit, klass = share.value
            par, part = dict(kept), TaskContext.get().partitionId()
            adam, room = Adam(par), Room(par, BATCH)
            rng, met, total = np.random.default_rng([seed, r, part]), np.zeros(len(kept["E"])), 0
            for batch in batches:
                for ids, units, n in _laid_out(batch, unit):
                    goals, (z, end, skip) = klass[ids], windows(n)
                    met += np.bincount(units, minlength=len(met))
                    total += len(ids)
                    mixed = rng.permutation(len(z))
                    for a in range(0, len(z), BATCH):
                        at = mixed[a:a + BATCH]
                        adam.step(gradients(par, *batch_of(units, goals, z[at], end[at], skip[at]), room)[1],
                                  RATE * (1 - r / ROUNDS) * min(1, (adam.t + 1) / 50))
            if not total:
                return
            rows = [(-1, np.array([total], float), np.concatenate([par[k].ravel() for k in others]))]
            rows += [(a, met[a:a + BLOCK], par["E"][a:a + BLOCK]) for a in range(0, len(met), BLOCK)]
            block, weight, value = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array([part] * len(rows), pa.int32()), pa.array([w.tobytes() for w in weight], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for v in value], pa.binary())], names=["block", "part", "weight", "value"])

        def averaged(key, group):
            weight, value = 0.0, 0.0
            for row in group.sort_by("part").to_pylist():     # one order of adding: reruns agree
                w = np.frombuffer(row["weight"])
                weight = weight + w
                value = value + w[:, None] * np.frombuffer(row["value"], np.float32).reshape(len(w), -1).astype(float)
            mean = (value / np.maximum(weight, 1)[:, None]).astype(np.float32)
            return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "weight": pa.array([weight.tobytes()], pa.binary()),
                             "value": pa.array([mean.tobytes()], pa.binary())})

        sums = map_arrow(ids.filter(F.col("round") == r).select(*STORED), run, "block int, part int, weight binary, value binary")
        par = {k: v.copy() for k, v in par.items()}
        for row in grouped_arrow(sums, ["block"], averaged, "block int, weight binary, value binary").toArrow().to_pylist():
            a, value = row["block"], np.frombuffer(row["value"], np.float32)
            if a < 0:
                for k, part in zip(others, np.split(value, ends[:-1])):
                    par[k] = part.reshape(par[k].shape).copy()
            else:
                met = np.frombuffer(row["weight"]) > 0
                par["E"][a:a + len(met)][met] = value.reshape(len(met), -1)[met]
        share.unpersist()
    return par


def laid(words: np.ndarray, codes: np.ndarray, size: np.ndarray, ids: np.ndarray):
    """Ids of all texts laid end to end, each text's ids between two end ids; the number of ids of each text; the words
    and ends before each text; the code of each word, -1 for each end; and the number of ids of each (the end's is 1)."""
    texts_n = len(words)
    before = np.concatenate([[0], np.cumsum(words)])
    # the words of a text, then its end; a leading end id opens each text
    order = np.full(len(codes) + texts_n, -1, np.int64)
    order[np.arange(len(codes)) + np.repeat(np.arange(texts_n), words)] = codes
    begin = np.append(np.cumsum(size) - size, len(ids))[order]
    size = np.append(size, 1)[order]
    body = np.append(ids.astype(np.int32), np.int32(END))[ragged(begin, size)]
    words_before = before + np.arange(texts_n + 1)
    ids_before = np.concatenate([[0], np.cumsum(size)])[words_before]
    n = np.diff(ids_before) + 1
    out = np.full(len(body) + texts_n, END, np.int32)
    out[np.arange(len(body)) + np.repeat(np.arange(1, texts_n + 1), np.diff(ids_before))] = body
    return out, n, words_before, order, size


def spelled(texts: pa.Array, enc):
    """Ids of all texts laid end to end, each text's ids between two end ids; the number
    of ids of each text; the word hashes with a 0 for each end; and the
    number of ids of each word (the end's is 1)."""
    words, codes, own, size, ids = worded(texts, enc)
    out, n, words_before, order, size = laid(words, codes, size, ids)
    return out, n, (np.append(own, 0)[order], words_before, order < 0), size


def place_scores(par: dict, z: np.ndarray, live: np.ndarray, klass: np.ndarray, room: Room | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Same model as :func:`forward`, for scoring: at the ``live`` places of
    windows ``z``, ln of the probability of class ``klass`` and of a word's beginning."""
    room = room or Room(par, len(z))
    # a window's products by itself: how texts are dealt does not change their scores
    y, _, value = exponents(par, attended(par, z, room, True)[0], np.flatnonzero(live), klass, room, True)
    # all classes, and those that begin a word
    pick = np.ones((y.shape[2], 2), np.float32)
    pick[BEGIN:, 1] = 0
    total, begin = (y @ pick).reshape(-1, 2)[:len(klass)].T
    return value - np.log(total), np.log(begin / total + np.float32(1e-30))


def word_scores(model: Model, ids: np.ndarray, n: np.ndarray, size: np.ndarray, is_end: np.ndarray, room: Room, batch: int = BATCH):
    """For every word of texts that :func:`spelled` laid out: its class, ln of
    the class's probability at a word's beginning, and ln of its
    spelling's probability given the class."""
    z, end, skip = windows(n)
    unit, klass = model.unit[ids], model.klass[ids]
    of_class, of_begin = np.zeros(len(ids), np.float32), np.zeros(len(ids), np.float32)
    step = np.arange(WINDOW)
    for a in range(0, len(z), batch):
        place = z[a:a + batch, None] + step
        last = end[a:a + batch, None] - 1
        live = (place < last) & (step >= skip[a:a + batch, None])
        to = place[live] + 1
        units = unit[np.minimum(place, last)]
        if len(units) < batch:      # a whole batch: how texts are dealt does not change their scores
            more = batch - len(units)
            units, live = (np.concatenate([x, np.zeros((more, WINDOW), x.dtype)]) for x in (units, live))
        of_class[to], of_begin[to] = place_scores(model.par, units, live, klass[to], room)
    opening = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else np.empty(0, np.int64)
    ids, of_class, of_begin = (np.delete(x, opening) for x in (ids, of_class, of_begin))
    first = np.cumsum(size) - size
    inner = of_class + model.inside[ids]
    inner[first] = model.inside[ids[first]]
    spelling = np.add.reduceat(inner.astype(np.float64), first) if len(first) else np.empty(0)
    # a word ends where another begins: the end of its text always follows
    spelling[~is_end] += of_begin[first[1:]][~is_end[:-1]]
    return model.klass[ids[first]], (of_class[first] - of_begin[first]).astype(np.float64), spelling


def logs(model: Model, first: np.ndarray, c: np.ndarray, order: np.ndarray, begin: np.ndarray, spelling: np.ndarray) -> np.ndarray:
    """ln of the probability of every word and end, in ``order`` given as places among the different words (-1: an end),
    which begin with ids ``first`` and have corpus counts ``c``."""
    mass = np.maximum(model.mass, 1e-9)
    free = np.minimum(1.0, np.where(model.mass > 0, DISCOUNT * model.kinds / mass, 1.0))
    k = model.klass[first]
    with np.errstate(divide="ignore"):
        own, free = np.log(np.maximum(c - DISCOUNT, 0) / mass[k]), np.log(free)[k]
    own, free = (np.append(x, 0.0)[order] for x in (own, free))
    return begin + np.where(order < 0, 0.0, np.logaddexp(own, free + spelling))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def fit(training: DataFrame, seed: int = 1, ids: DataFrame | None = None):
    """The model and the corpus counts: ``(model, vocabulary table (h, c),
    hot hashes, hot counts, N, V, texts)``. Counts, classes and the layer are over all rows of
    ``training(id, text)``; a bounded sample is only where the layer starts. ``ids`` are the stored texts, if there are
    (:func:`text_ids`), those that are not for learning beside them."""
    ids = text_ids(training) if ids is None else ids.filter("round >= 0")
    words = written(word_counts(ids), "words")
    texts = training.count()
    total = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = (total["n"] or 0) + texts, total["v"] + (texts > 0)
    # a count that at most HOT_WORDS words reach: sixteenths of an octave, read from the top
    by_size = sorted((r["s"], r["n"]) for r in words.groupBy(F.floor(F.log2("c") * 16).alias("s"))
                     .agg(F.count(F.lit(1)).alias("n")).collect())
    room, least = HOT_WORDS, None
    for s, n in reversed(by_size):
        if n > room:
            break
        room, least = room - n, s
    is_hot = F.floor(F.log2("c") * 16) >= F.lit(least if least is not None else 1 << 20)
    hot = words.filter(is_hot).select("h", "c").toArrow()
    enc = encoder(vocabulary())
    hot_h, hot_c = hot.column("h").to_numpy(), hot.column("c").to_numpy()
    counts, kinds, first_c, first_v = _subword_sums(words)
    counts[END] += texts
    order = np.argsort(hot_h)
    picked = (training.select("id").filter("id is not null").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(SAMPLE_DOCS)
              .distinct())
    known = training.filter("text <> ''").join(F.broadcast(picked), "id").withColumnRenamed("id", "_id")
    filled = sizes(known).select("_id", "h", *sample_places(SAMPLE_BYTES, [], seed))
    # where no text fits, the beginning of the shortest one: windows are all that is learned from
    fit_in = filled.filter((F.col("upto") <= SAMPLE_BYTES) | (F.col("place") == 1))
    sample = (chosen(known, fit_in).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id", F.xxhash64("text"))
              .select(F.when(F.octet_length("text") > SAMPLE_BYTES, F.substring("text", 1, SAMPLE_BYTES // 4))
                      .otherwise(F.col("text")).alias("text")).toArrow())
    sample = [t for t in sample.column(0).to_pylist() if t] or [""]
    model = train(sample, counts, kinds, enc, seed, neighbours(ids, *units_of(counts)))
    model.par = learned(model, ids, seed)
    model.mass[:] = np.bincount(model.klass, first_c, CLASSES)
    model.kinds[:] = np.bincount(model.klass, first_v, CLASSES)
    return model, words.filter(~is_hot).select("h", "c"), hot_h[order], hot_c[order], tokens, distinct, texts


def _subword_sums(words: DataFrame) -> np.ndarray:
    """For every subword id, over the whole vocabulary: its occurrences in all tokens
    and in different words, and the tokens and different words that begin with it."""
    def run(batches):
        sums = np.zeros((4, END + 1))
        for batch in batches:
            data, off = utf8(batch.column(0))
            ids, c = np.frombuffer(data.tobytes(), np.uint16), batch.column(1).to_numpy()
            first = ids[off[:-1] // 2]
            for row, (i, w) in zip(sums, ((ids, np.repeat(c, np.diff(off) // 2)), (ids, None), (first, c), (first, None))):
                row += np.bincount(i, w, END + 1)
        i = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(i)] + [pa.array(x[i]) for x in sums], names=["i", "c", "v", "fc", "fv"])

    rows = map_arrow(words.select("word", "c"), run, "i long, c double, v double, fc double, fv double").groupBy("i").agg(
        *[F.sum(x).alias(x) for x in ("c", "v", "fc", "fv")]).toArrow()   # one row per subword id
    sums = np.zeros((4, END + 1))
    sums[:, rows.column("i").to_numpy()] = [rows.column(x).to_numpy() for x in ("c", "v", "fc", "fv")]
    return sums


def own_counts(h: np.ndarray, hot_h: np.ndarray, hot_c: np.ndarray) -> np.ndarray:
    """Corpus counts of frequent words, 0 for others."""
    if not len(hot_h):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(hot_h, h), len(hot_h) - 1)
    return np.where(hot_h[at] == h, hot_c[at], 0)


def score(docs: DataFrame, fitted, id_col: str = "doc_id", text_col: str = "text", ids: DataFrame | None = None) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` of every whole
    text. A null or empty text is its end token alone. Equal rows are scored
    each; other columns are not read. ``ids`` are the stored texts, if there are (:func:`text_ids`)."""
    model, rare, hot_h, hot_c, tokens, distinct, n_texts = fitted
    spark = docs.sparkSession
    ids = text_ids(docs, id_col, text_col) if ids is None else ids
    # arrays only: executors need not know the class
    share = spark.sparkContext.broadcast((tuple(getattr(model, f) for f in FIELDS), hot_h, hot_c, id_sums(encoder(vocabulary()))))
    floor = float(np.log10(1.0 / (tokens + distinct + 1)))

    def run(batches):
        fields, hot_h, hot_c, id_parts = share.value
        model = Model(*fields)
        room = Room(model.par, BATCH)
        for batch in batches:
            for keys, (words, codes, size, sub) in zip(batch.column("keys"), _stored_texts(batch)):
                h = joined_hashes(*id_parts, sub, size).view(np.int64)
                spelt, n, before, order, sizes = laid(words, codes, size, sub)
                is_end = order < 0
                k, begin, spelling = word_scores(model, spelt, n, sizes, is_end, room)
                c = own_counts(h, hot_h, hot_c)
                value = logs(model, sub[np.cumsum(size) - size], c, order, begin, spelling) / np.log(10)
                c = np.append(c, n_texts)
                base = (np.log10(c + 1.0) + floor)[order]
                c, h = c[order], np.append(h, 0)[order]
                sums = lambda x: np.add.reduceat(x, before[:-1])
                lone = (c == 0) & ~is_end
                texts = len(words)
                doc = np.repeat(np.arange(texts), np.diff(before))
                # one head row per text, then one row per rare word of it
                rows = np.concatenate([np.arange(texts), doc[lone]])
                key = np.concatenate([np.zeros(texts, np.int64), h[lone]])
                zeros = np.zeros(int(lone.sum()))
                out = [keys.values.take(pa.array(rows)), pa.array(key), pa.array(np.arange(len(rows)) < texts),
                       pa.array(np.concatenate([np.diff(before), zeros]).astype(np.int64)),
                       pa.array(np.concatenate([sums((c > 0).astype(np.int64)), zeros]).astype(np.int64)),
                       pa.array(np.concatenate([sums(np.where(lone, 0.0, base)), zeros])),
                       pa.array(np.concatenate([sums(np.where(lone, 0.0, value)), value[lone]])),
                       pa.array(np.concatenate([np.zeros(texts), begin[lone] / np.log(10)])),
                       pa.array(np.concatenate([np.ones(texts), np.maximum(model.mass[k[lone]], 1e-9)]))]
                yield pa.RecordBatch.from_arrays(out, names=["row", "h", "head", "n_tokens", "n_known", "base", "score", "begin", "mass"])

    kind = docs.schema[id_col].dataType.simpleString()
    parts = map_arrow(ids.select("keys", *STORED), run, f"row struct<r:long,id:{kind}>, h long, head boolean, n_tokens long, n_known long, base double, score double, begin double, mass double")
    # heads spread by row: they look up nothing
    parts = parts.withColumn("h", F.when(F.col("head"), F.col("row.r")).otherwise(F.col("h")))
    lone = ~F.col("head")
    seen = parts.join(rare, "h", "left")
    # a rare word's own share joins its spelling, as in logs()
    own = F.col("begin") + F.log10((F.col("c") - F.lit(DISCOUNT)) / F.col("mass"))
    high, low = F.greatest(own, "score"), F.least(own, "score")
    both = high + F.log10(F.lit(1.0) + F.pow(F.lit(10.0), low - high))
    gone = seen.select("row", "n_tokens", F.when(lone & F.col("c").isNotNull(), both).otherwise(F.col("score")).alias("score"),
                       (F.col("n_known") + (lone & F.col("c").isNotNull()).cast("long")).alias("n_known"),
                       (F.col("base") + F.when(lone, F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1.0) + F.lit(floor)).otherwise(F.lit(0.0))).alias("base"))
    summed = gone.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return summed.select(F.col("row.id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         F.col("base").alias("base_score"), "score")


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), text_column(docs).alias("text"))
    ids = text_ids(docs, "doc_id", learns=~held_out(F.col("doc_id")))
    scored = score(docs, fit(training, ids=ids), ids=ids)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")

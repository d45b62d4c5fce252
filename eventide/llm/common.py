"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.session import checkpoint_root, scratch_path

#: ASCII white space separates words: ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Compute once and continue from a reliable copy in the shared
    checkpoint folder, which survives the loss of an executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute once and continue from a Parquet table in the shared checkpoint folder: like
    ``stored``, smaller on disk, and read by column."""
    place = scratch_path(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` whose function travels by value, so that executors need
    no copy of this package."""
    _by_value()
    _small_batches(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def grouped_arrow(df: DataFrame, keys: Sequence[str], fn, schema: str) -> DataFrame:
    """``applyInArrow`` on groups whose size the caller bounds."""
    _by_value()

    def by_key(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        out = fn(key, group)
        give_back()
        return out

    return df.groupBy(*keys).applyInArrow(by_key, schema)


def cogrouped_arrow(left: DataFrame, right: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """``applyInArrow`` on pairs of groups whose size the caller bounds."""
    _by_value()

    def by_key(key: tuple[pa.Scalar, ...], one: pa.Table, two: pa.Table) -> pa.Table:
        out = fn(key, one, two)
        give_back()
        return out

    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(by_key, schema)


def _by_value() -> None:
    import eventide
    cloudpickle.register_pickle_by_value(eventide)


#: Bytes of an Arrow batch between Spark and a Python worker; each lies in both several times.
BATCH_BYTES = 8 << 20


def _small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES``; a smaller bound of its own stays. By default they hold
    10,000 rows or 64 MB, which with whole texts takes hundreds of MB of an executor."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: a Python worker
    waits for its next task beside the other processes of its executor."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):    # not glibc
        pass


def per_process(key, build: Callable):
    """Build a read-only helper once per Python worker (a compiled tokenizer,
    a lookup table); a new task of the same worker finds it again."""
    kept = sys.__dict__.setdefault("_eventide_per_process", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def text_column(df: DataFrame, name: str = "text"):
    """The text column as a string, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and its n + 1 offsets;
    no copy of the text is made."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    bufs = column.buffers()
    if len(column) == 0 or bufs[1] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(bufs[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


#: True for the six ASCII white space bytes that end a word.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the concatenated texts, and the
    number of words before each text (n + 1 entries). Words never cross
    from one text into the next."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = off[:-1][off[:-1] < len(data)]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = off[1:][(off[1:] > 0)] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (splitmix64 finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd base of byte polynomials and its inverse modulo 2^64.
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to 4095 of ``base`` modulo 2^64, and those of its 4096th power up to
    ``n`` / 4096: small enough for a worker to keep."""
    def run(first: int, size: int) -> np.ndarray:
        out = np.full(size, first & (1 << 64) - 1, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    kept = per_process(("powers", base), lambda: [run(base, 4096), np.ones(1, np.uint64)])
    if len(kept[1]) <= n >> 12:
        kept[1] = run(pow(base, 4096, 1 << 64), 1 << (n >> 12).bit_length())
    return kept[0], kept[1]


def first_powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0 to n - 1 modulo 2^64."""
    low, high = _power_tables(base, n)
    return np.multiply.outer(high[:(n >> 12) + 1], low).ravel()[:n]


def powers_at(base: int, places: np.ndarray) -> np.ndarray:
    """``base`` to the power of every place modulo 2^64."""
    low, high = _power_tables(base, int(places.max(initial=0)))
    return high[places >> 12] * low[places & 4095]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial of its bytes and length,
    from one running sum over all bytes (arithmetic modulo 2^64)."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    return _finished(_byte_sums(data, starts, ends, seed), ends - starts)


def _byte_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    n = len(data)
    table = per_process(("byte values", seed), lambda: mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000003)))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * first_powers(ODD, n), out=total[1:])
    return (total[ends] - total[starts]) * powers_at(INVERSE, starts)


def _finished(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix64(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def part_sums(parts: Sequence[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """What each part of a word adds to its hash, and the parts' lengths: see :func:`joined_hashes`."""
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return _byte_sums(np.frombuffer(b"".join(parts), np.uint8), off[:-1], off[1:], seed), np.diff(off)


def joined_hashes(sums: np.ndarray, lengths: np.ndarray, parts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The hash that :func:`word_hashes` gives of every word that ``size`` (at least 1) parts each make up, laid end to end
    as places in ``sums`` and ``lengths`` of :func:`part_sums`."""
    if len(size) == 0:
        return np.empty(0, np.uint64)
    n, first = lengths[parts], np.cumsum(size) - size
    before = np.cumsum(n) - n
    value = sums[parts] * powers_at(ODD, before - np.repeat(before[first], size))
    return _finished(np.add.reduceat(value, first), np.add.reduceat(n, first))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: one row ``(id, component)`` per
    node of an edge, ``component`` the smallest id it can reach.

    Alternating large-star and small-star steps; each step is a partial
    aggregate and an equi-join (whose hot nodes Spark may split), each round
    is stored, and the driver reads one line of totals per round.
    """
    pairs = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter("u <> v").distinct())
    pairs = stored(pairs)
    seen = None
    while True:
        totals = pairs.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("starred"),
                           F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if totals["n"] == 0 or tuple(totals) == seen:
            break
        seen = tuple(totals)
        # large star: the larger neighbours of a node move to its smallest one
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        pairs = stored(joined.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct())
    # a fixed point is a set of stars: each node but the smallest points at the smallest
    stars = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stored(stars.unionByName(stars.select(F.col("component").alias("id"), "component")).distinct())


def order_rank(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """The 0-based position of every row of a small table (one row per source
    or partition) along ``order``."""
    return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))

"""Approximate nearest neighbours from randomly rotated one-bit codes.

Unit vectors are centred on their mean, and the residual's direction is turned
by a seeded random rotation; the signs of its coordinates are its code, packed
into bytes. With it go two correction scalars: the residual's length and the
inner product of the direction with its own code's direction. A query's
inner product with a direction is estimated from the packed code alone (one
table of partial sums per code byte) divided by that scalar, which is free of
bias, and lies within ``width * sqrt((1 - s^2) / (s^2 (D - 1)))`` of the truth
but for rare cases. A first pass over the codes gives each query its k-th
largest lower bound; a second pass computes the exact cosine of the vectors whose
upper bound reaches it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from eventide.llm.common import map_arrow, mix64, table, utf8, written
from eventide.llm.grid_join import unit_rows, usable

NEAREST, QUERY_STEP, WIDTH = 5, 50, 2.5
#: A slab has at least SLAB_ROWS vectors if there are so many; beyond SLABS slabs they grow to SLAB_BYTES of vectors.
SLAB_ROWS, SLABS, SLAB_BYTES = 4096, 32, 128 << 20
QUERY_ROWS, CODE_ROWS = 1024, 1024     # queries and codes whose products are computed at once
PAIR_CELLS = 1 << 20                   # components that are multiplied at once for exact cosines


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign codes, residual lengths and ``<direction, code direction>``."""
    res = units - centre
    length = np.sqrt((res * res).sum(axis=1))
    turned = (res / np.maximum(length, 1e-300)[:, None]) @ turn
    bits = turned >= 0
    own = np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])
    return np.packbits(bits, axis=1), length, own


def code_side(codes: np.ndarray, length: np.ndarray, own: np.ndarray, at_centre: np.ndarray, dim: int, kind=np.float32) -> np.ndarray:
    """A row per code: its product with a row of :func:`query_side` is the estimated cosine plus
    so many times the half width of its error bound as the query side asks for."""
    safe = np.maximum(own, 1e-12)
    # <x, q> = <r, q - c> + <x, c>, with r = length * direction and x = c + r
    out = np.empty((len(codes), dim + 2), kind)
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(kind) * 2 - 1
    np.multiply(signs[codes].reshape(len(codes), -1)[:, :dim], (length / safe / np.sqrt(dim)).astype(kind)[:, None], out=out[:, :dim])
    out[:, dim] = at_centre
    out[:, dim + 1] = np.sqrt(np.maximum(0, 1 - own * own)) / safe / np.sqrt(max(dim - 1, 1)) * length
    return out


def query_side(queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, width: float, kind=np.float32) -> np.ndarray:
    turned = (queries - centre) @ turn
    spread = np.sqrt((turned * turned).sum(axis=1))
    return np.column_stack([turned, np.ones(len(queries)), width * spread]).astype(kind)


def estimate(codes: np.ndarray, length: np.ndarray, own: np.ndarray, at_centre: np.ndarray, queries: np.ndarray,
             centre: np.ndarray, turn: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of every query with every coded vector, and the half
    width of its error bound. ``at_centre`` is each coded unit vector's inner
    product with the centre."""
    code = code_side(codes, length, own, at_centre, queries.shape[1], np.float64)
    query = query_side(queries, centre, turn, width, np.float64)
    return query[:, :-1] @ code[:, :-1].T, query[:, -1:] * code[:, -1] + 1e-9


def _slack(dim: int) -> float:
    """What rounding in single precision may add to or take from a cosine or its bound."""
    return 1e-6 * np.sqrt(dim + 2)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
            query_step: int = QUERY_STEP, width: float = WIDTH, seed: int = 11, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """For every row whose id is divisible by ``query_step``: its ``k`` nearest
    other rows by cosine, ``(query_id, rank, vec_id, score)``, nearest first, ties
    to the smaller id; ``score`` is the exact cosine in double precision.

    Vectors that are null, zero or hold a null, NaN or infinite component take
    no part, nor do rows with a null id; a query meets only vectors of its own
    dimension count. Ids are taken as unique. All rows are coded and searched:
    every query meets every code. Other columns are not read.

    Vectors are coded once and stored with their codes. They are dealt over slabs, few and
    large ones, as every query is sent to each slab. A task holds a slab's codes (and vectors, in the second
    pass) and streams the queries past them; nothing is joined or broadcast but the queries' floors.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    held = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), held.alias("v"))
    good = rows.filter(F.col("id").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False))).withColumn("dim", F.size("v"))
    centres, sizes = _centres(good)
    turns = {d: rotation(d, seed + d) for d in centres}

    def code(batches):
        for batch in (b.slice(at, CODE_ROWS) for b in batches for at in range(0, b.num_rows, CODE_ROWS)):
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                units = unit_rows(part.column("v"), d)
                codes, length, own = encode(units, centres[d], turns[d])
                ends = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("dim"), part.column("id"), part.column("v"),
                     pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())]),
                     pa.array(length), pa.array(own), pa.array(units @ centres[d])],
                    names=["dim", "id", "v", "code", "length", "own", "at_centre"])

    coded = written(map_arrow(good.select("dim", "id", "v"), code, "dim int, id long, v array<" + ("float" if single else "double")
                              + ">, code binary, length double, own double, at_centre double"), "rotated-codes")
    asked = coded.filter(F.col("id") % query_step == 0).select("dim", "id", "v")
    size_of = 4 if single else 8
    slabs = {d: max(min(-(-n // slab_rows), SLABS), -(-n * d * size_of // SLAB_BYTES)) for d, n in sizes.items()}

    def first(batches):
        for d, slab, ids, query in _met(batches):
            yield _lows(slab, ids, unit_rows(query.column("v"), d), centres[d], turns[d], width, k)

    def second(batches):
        for d, slab, ids, query in _met(batches, k):
            floor = query.column("low").to_numpy(zero_copy_only=False).astype(np.float64)
            yield _found(slab, ids, unit_rows(query.column("v"), d), np.where(np.isnan(floor), -np.inf, floor),
                         centres[d], turns[d], width, k)

    lows = map_arrow(_dealt(coded.drop("v"), asked, slabs), first, "query_id long, score double")
    top = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    floors = (lows.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k)
              .groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
              .select("id", F.when(F.col("n") >= k, F.col("low")).alias("low")))
    floored = asked.join(floors, "id", "left").select("dim", "id", "v", "low")
    found = map_arrow(_dealt(coded, floored, slabs), second, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _dealt(coded: DataFrame, asked: DataFrame, slabs: dict[int, int]) -> DataFrame:
    """Every code in its slab and every query in each slab of its dimension count, a slab's
    codes before the queries in one partition. ``slabs``: number by dimension count."""
    first = dict(zip(slabs, np.cumsum([0, *slabs.values()]).tolist()))

    def of(numbers: dict[int, int]) -> Column:
        known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]).cast("map<int,bigint>")
        return F.element_at(known, F.col("dim")) if numbers else F.lit(1).cast("long")

    codes = coded.withColumns({"slab": of(first) + F.pmod(F.xxhash64("id"), of(slabs)), "asks": F.lit(0)})
    queries = asked.withColumns({"slab": F.explode(F.sequence(of(first), of(first) + of(slabs) - 1)), "asks": F.lit(1)})
    n = max(1, min(sum(slabs.values()), 10_000))
    rows = codes.unionByName(queries, allowMissingColumns=True)
    return rows.repartitionById(n, F.pmod("slab", F.lit(n)).cast("int")).sortWithinPartitions("slab", "asks")


def _centres(good: DataFrame) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Mean unit vector and number of vectors per dimension count (one row each)."""
    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            col = b.column(0)
            sizes = np.diff(col.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                x = unit_rows(col.filter(pa.array(sizes == d)), d)
                total[d] = total.get(d, 0) + np.append(x.sum(axis=0), len(x))
        for d, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * (d + 1), pa.int32()), pa.array(range(d + 1), pa.int32()), pa.array(s)],
                                             names=["dim", "at", "x"])
    parts = map_arrow(good.select("v"), sums, "dim int, at int, x double")
    rows = (parts.groupBy("dim", "at").agg(F.sum("x").alias("x")).groupBy("dim")
            .agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("m"))).collect()
    means = {r["dim"]: np.array([e["x"] for e in r["m"]]) for r in rows}
    return {d: m[:-1] / m[-1] for d, m in means.items()}, {d: int(m[-1]) for d, m in means.items()}


def _met(batches: Iterator[pa.RecordBatch], k: int | None = None) -> Iterator[tuple[int, list, np.ndarray, pa.RecordBatch]]:
    """Rows of :func:`_dealt`: ``(dimension count, slab, query ids, queries)`` for at most ``QUERY_ROWS``
    queries at a time, with the slab's ids, codes, scalars and, given ``k``, vectors."""
    now, parts, slab = None, [], None
    for batch in batches:
        key = batch.column("slab").to_numpy() * 2 + batch.column("asks").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            run, d = batch.slice(lo, hi - lo), batch.column("dim")[lo].as_py()
            if key[lo] // 2 != now:
                now, parts, slab = key[lo] // 2, [], None
            if key[lo] % 2 == 0:
                cols = [run.column("id").to_numpy(), utf8(run.column("code"))[0].reshape(hi - lo, -1),
                        *[run.column(c).to_numpy() for c in ("length", "own", "at_centre")]]
                # copies: a slice would keep its whole batch
                parts.append([c.copy() for c in cols + ([_vectors(run, d)] if k else [])])
                continue
            if slab is None and parts:
                slab, parts = [np.concatenate(c) for c in zip(*parts)], []
                if k:
                    rest = _without_copies(slab[0], slab[-1], k)
                    slab = slab if rest.all() else [c[rest] for c in slab]
                slab.insert(0, np.argsort(slab[0]))
            if slab is not None:
                for at in range(0, hi - lo, QUERY_ROWS):
                    query = run.slice(at, QUERY_ROWS)
                    yield d, slab, query.column("id").to_numpy(), query


def _vectors(run: pa.RecordBatch, dim: int) -> np.ndarray:
    return run.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _without_copies(ids: np.ndarray, raw: np.ndarray, k: int) -> np.ndarray:
    """False for rows that no query can be given: ``k`` rows of the same vector
    and another id than the query's come before them, for every query."""
    bits = raw.view(np.uint32 if raw.itemsize == 4 else np.uint64)
    by = mix64(np.arange(1, bits.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    h = np.concatenate([mix64(bits[at:at + 4096].astype(np.uint64)) @ by for at in range(0, len(bits), 4096)])
    order = np.lexsort((ids, h))
    h, i = h[order], ids[order]
    new = np.append(True, h[1:] != h[:-1])
    start, group = np.flatnonzero(new), np.cumsum(new) - 1
    rank = np.arange(len(h)) - start[group]
    if rank.max() <= k:
        return np.ones(len(ids), bool)
    run = np.flatnonzero(new | np.append(True, i[1:] != i[:-1]))
    often = np.zeros(len(start), np.int64)
    np.maximum.at(often, group[run], np.diff(np.append(run, len(h))))
    late = np.flatnonzero(rank >= k + often[group])
    late = late[(bits[order[late]] == bits[order[start[group[late]]]]).all(axis=1)]
    out = np.ones(len(ids), bool)
    out[order[late]] = False
    return out


def _own(names: np.ndarray, ids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ids that are a query's own, ascending, and that query's. ``order`` sorts ids."""
    low, high = (np.searchsorted(ids, names, side, sorter=order) for side in ("left", "right"))
    n = high - low
    at = order[np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())]
    by = np.argsort(at)
    return at[by], np.repeat(np.arange(len(names)), n)[by]


def _strip(own: tuple[np.ndarray, np.ndarray], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a block of queries by the codes ``lo`` to ``hi`` where a query meets itself."""
    a, b = np.searchsorted(own[0], [lo, hi])
    return own[1][a:b], own[0][a:b] - lo


def _true_at(hit: np.ndarray) -> np.ndarray:
    """``flatnonzero`` of a contiguous block with few true cells: eight at a time."""
    flat = hit.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    word = np.flatnonzero(flat.view(np.uint64))
    i, j = np.nonzero(flat.reshape(-1, 8)[word])
    return word[i] * 8 + j


def _runs_of(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of an ascending array, and the place of each entry's value there."""
    new = np.append(True, r[1:] != r[:-1])
    return r[new], np.cumsum(new) - 1


def _last(row: np.ndarray, count: int, k: int, *by: np.ndarray) -> np.ndarray:
    """Places of the last ``k`` of each of ``count`` rows (at least ``k`` each) in the order ``by``."""
    order = np.lexsort((*by[::-1], row))
    ends = np.cumsum(np.bincount(row, minlength=count))
    return order[ends[:, None] - k + np.arange(k)]


def _blocks(rows: int, *kinds) -> Callable[[int], list[np.ndarray]]:
    """Places for blocks of ``rows`` by so many columns each, used again and again: fresh memory costs more than the products."""
    kept = [np.empty(rows * CODE_ROWS, kind) for kind in kinds]
    return lambda wide: [x[:rows * wide].reshape(rows, wide) for x in kept]


def _lows(slab, names, units, centre, turn, width, k) -> pa.RecordBatch:
    """First pass: each query's ``k`` largest lower bounds in the slab."""
    order, ids, codes, length, own, at_centre = slab
    dim = units.shape[1]
    query, itself = query_side(units, centre, turn, -width), _own(names, ids, order)
    best = np.full((len(names), k), -np.inf, np.float32)     # ascending
    blocks = _blocks(len(names), np.float32, bool)
    for lo in range(0, len(ids), CODE_ROWS):
        c = slice(lo, lo + CODE_ROWS)
        low, hit = blocks(len(ids[c]))
        np.matmul(query, code_side(codes[c], length[c], own[c], at_centre[c], dim).T, out=low)
        low[_strip(itself, lo, lo + CODE_ROWS)] = -np.inf
        np.greater(low, best[:, :1], out=hit)
        count = np.count_nonzero(hit)
        if count > 8 * k * len(names):
            best = np.sort(np.partition(np.concatenate([best, low], axis=1), -k, axis=1)[:, -k:], axis=1)
        elif count:
            flat = _true_at(hit)
            rows, r = _runs_of(flat // low.shape[1])
            value = np.concatenate([best[rows].ravel(), low.reshape(-1)[flat]])
            best[rows] = value[_last(np.concatenate([np.repeat(np.arange(len(rows)), k), r]), len(rows), k, value)]
    r, c = np.nonzero(best > -np.inf)
    return pa.RecordBatch.from_arrays([pa.array(names[r]), pa.array(best[r, c].astype(np.float64) - _slack(dim))],
                                      names=["query_id", "score"])


def _found(slab, names, units, floor, centre, turn, width, k) -> pa.RecordBatch:
    """Second pass: of the slab's vectors whose upper bound reaches the query's
    floor, the ``k`` of largest exact cosine, ties to the smaller id. Where many reach it, cosines in
    single precision leave out those that are surely not among the ``k``."""
    order, ids, codes, length, own, at_centre, raw = slab
    dim = units.shape[1]
    slack = np.float32(_slack(dim))
    query, short, itself = query_side(units, centre, turn, width), units.astype(np.float32), _own(names, ids, order)
    score = np.full((len(names), k), -np.inf)                # ascending, equal ones by falling id
    vec = np.full((len(names), k), np.iinfo(np.int64).max)
    least = floor.astype(np.float32)[:, None] - slack
    step, blocks = max(1, PAIR_CELLS // dim), _blocks(len(names), np.float32, bool, bool)
    for lo in range(0, len(ids), CODE_ROWS):
        c = slice(lo, lo + CODE_ROWS)
        near, ask, still = blocks(len(ids[c]))
        np.matmul(query, code_side(codes[c], length[c], own[c], at_centre[c], dim).T, out=near)
        np.greater_equal(near, least, out=ask)
        ask[_strip(itself, lo, lo + CODE_ROWS)] = False
        hits = np.count_nonzero(ask)
        if not hits:
            continue
        unit = raw[c].astype(np.float64)
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        if hits > ask.size // 256:
            np.matmul(short, unit.astype(np.float32).T, out=near)
            np.greater_equal(near, score[:, :1].astype(np.float32) - slack, out=still)
            ask &= still
            if np.count_nonzero(ask) > 8 * k * len(names):
                near[~ask] = -np.inf
                ask &= near >= np.partition(near, -min(k, near.shape[1]), axis=1)[:, -min(k, near.shape[1]), None] - 2 * slack
        flat, wide = _true_at(ask), ask.shape[1]
        for p in range(0, len(flat), step):
            r, j = np.divmod(flat[p:p + step], wide)
            exact = (unit[j] * units[r]).sum(axis=1)
            rows, r = _runs_of(r)
            value = np.concatenate([score[rows].ravel(), exact])
            whose = np.concatenate([vec[rows].ravel(), ids[c][j]])
            last = _last(np.concatenate([np.repeat(np.arange(len(rows)), k), r]), len(rows), k, value, ~whose)
            score[rows], vec[rows] = value[last], whose[last]
    r, j = np.nonzero(score > -np.inf)
    return pa.RecordBatch.from_arrays([pa.array(names[r]), pa.array(vec[r, j]), pa.array(score[r, j])],
                                      names=["query_id", "vec_id", "score"])


def op2_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))

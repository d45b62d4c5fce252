"""Ordered per-key scans that do not put a hot key into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` hashes every row of a key to
one task; if one key holds a third of the data, that task sorts a third of
the data. ``deal`` range-partitions the rows by (keys, order) instead, and the
number of its range becomes a row's *chunk*. Ranges hold about equally many rows
whatever the distribution of times is, equal times are split by the later
order columns, and a key that fits into a range is one chunk. The window
functions then run per (chunk, key).

What crosses a chunk border is carried: ranges are contiguous, so at most one
key of a chunk can go on from an earlier one. Only these keys are summed per
chunk, and the table of carries has at most one row per range, a proven bound
under which it is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.session import materialize

CHUNK = "_scan_chunk"


def value_chunk(value: Column | str, width: int) -> Column:
    """Chunk id that grows with a numeric column: ``floor(value / width)``."""
    col = F.col(value) if isinstance(value, str) else value
    return F.floor(col / F.lit(width))


def deal(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` range-partitioned by (keys, order), NULLs first as in a window, with
    the range number as column ``_scan_chunk``. ``ranges`` defaults to the
    session's shuffle partitions; choose it so that a range fits a task. The
    dealt rows are stored, so every later step sees the same ranges and the
    input is read twice (once to sample the range bounds)."""
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return materialize(dealt.withColumn(CHUNK, F.spark_partition_id()), "dealt")


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df if CHUNK in df.columns else deal(df, keys, order)


def _spanning(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is the first or last of its chunk: only such
    keys can lie in several chunks. The list of them has two rows per range."""
    if not keys:
        return df
    edge = df.groupBy(CHUNK).agg(F.min(F.struct(*keys)).alias("_lo"), F.max(F.struct(*keys)).alias("_hi"))
    edge = (edge.select(CHUNK, F.explode(F.array("_lo", "_hi")).alias("_k")).distinct()
            .select(CHUNK, *[F.col(f"_k.{k}").alias(k) for k in keys]))
    return join_on(df, F.broadcast(edge), [CHUNK, *keys], "left_semi")


def _vname(name: str) -> str:
    return f"_scan_v_{name}"


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Mapping[str, Column], inclusive: bool = True) -> DataFrame:
    """Add running sums of ``values`` per key along ``order``.

    ``order`` must be a total order within a key (add a tie-breaker).
    ``inclusive`` counts the current row; otherwise only earlier rows.
    Results are never null (0 before the first row). ``df`` may have been
    dealt already; the chunk column then stays on the result.
    """
    keys, order, names = list(keys), list(order), list(values)
    had = CHUNK in df.columns
    base = _dealt(df, keys, order).withColumns({_vname(n): values[n] for n in names})
    totals = _spanning(base, keys).groupBy(CHUNK, *keys).agg(*[F.sum(_vname(n)).alias(_vname(n)) for n in names])
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(CHUNK, *keys, *[F.sum(_vname(n)).over(before).alias(f"_scan_c_{n}") for n in names])
    carry = carry.dropna(how="all", subset=[f"_scan_c_{n}" for n in names])
    w = (Window.partitionBy(CHUNK, *keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    local = base.withColumns({n: F.sum(_vname(n)).over(w) for n in names})
    out = join_on(local, F.broadcast(carry), [CHUNK, *keys], "left")
    out = out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_scan_c_{n}"), F.lit(0)) for n in names})
    return out.drop(*[_vname(n) for n in names], *[f"_scan_c_{n}" for n in names], *([] if had else [CHUNK]))


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    values: Mapping[str, Column], exists: str | None = None) -> DataFrame:
    """Add, per key, the values of the previous row along ``order`` (NULL
    for the first row of a key), and with ``exists`` whether there is one.
    ``order`` columns are ascending and must be a total order within a key."""
    keys, order, names = list(keys), list(order), list(values)
    had = CHUNK in df.columns
    base = _dealt(df, keys, order).withColumns({_vname(n): values[n] for n in names})
    row = F.struct(*[F.col(_vname(n)).alias(n) for n in names], F.lit(True).alias("_is"))
    last = _spanning(base, keys).groupBy(CHUNK, *keys).agg(F.max_by(row, F.struct(*order)).alias("_scan_last"))
    carry = last.select(CHUNK, *keys, F.lag("_scan_last").over(
        Window.partitionBy(*keys).orderBy(CHUNK)).alias("_scan_carry")).filter("_scan_carry is not null")
    local = base.withColumn("_scan_prev", F.lag(row).over(Window.partitionBy(CHUNK, *keys).orderBy(*order)))
    out = join_on(local, F.broadcast(carry), [CHUNK, *keys], "left")
    prev = F.coalesce(F.col("_scan_prev"), F.col("_scan_carry"))
    out = out.withColumns({n: prev[n] for n in names})
    if exists:
        out = out.withColumn(exists, prev.isNotNull())
    return out.drop("_scan_prev", "_scan_carry", *[_vname(n) for n in names], *([] if had else [CHUNK]))


def segment_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Sequence[str], starts, chunk: Column, name: str = "segment_id") -> DataFrame:
    """Gaps and islands: the 1-based id of each row's segment per key along
    ``order`` (ascending, total). ``starts(prev, cur)`` says whether a row
    opens a new segment, given ``{column: Column}`` of the previous row and
    of the row itself for the columns in ``values``; the first row of a key
    always opens one.

    One window pass over ``(keys, chunk)`` gives each row its in-chunk
    segment starts so far; that table is stored once. A per-chunk summary
    (first and last row's values, inner starts: one row per chunk) gives
    each chunk its carry (starts of all earlier chunks, and whether its
    first row opens a segment), which a join adds to the rows.
    """
    keys, order, values = list(keys), list(order), list(values)
    base = df.withColumn(CHUNK, chunk)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    prev = {c: F.lag(c).over(w) for c in values}
    cur = {c: F.col(c) for c in values}
    first = F.row_number().over(w) == 1
    flagged = base.withColumn("_seg_f", F.when(first, F.lit(0))
                              .when(F.coalesce(starts(prev, cur), F.lit(False)), F.lit(1))
                              .otherwise(F.lit(0)))
    local = materialize(flagged.withColumn(
        "_seg_l", F.sum("_seg_f").over(w.rowsBetween(Window.unboundedPreceding, 0))), "segments")
    ordering = F.struct(*order)
    summary = local.groupBy(*keys, CHUNK).agg(
        F.min_by(F.struct(*values), ordering).alias("_seg_first"),
        F.max_by(F.struct(*values), ordering).alias("_seg_last"),
        F.sum("_seg_f").alias("_seg_inner"))
    wc = Window.partitionBy(*keys).orderBy(CHUNK)
    prev_last = F.lag("_seg_last").over(wc)
    opens = F.coalesce(starts({c: prev_last[c] for c in values},
                              {c: F.col("_seg_first")[c] for c in values}), F.lit(False))
    summary = summary.withColumn(
        "_seg_b", F.when(prev_last.isNull() | opens, F.lit(1)).otherwise(F.lit(0)))
    summary = summary.withColumn("_seg_carry", F.coalesce(
        F.sum(F.col("_seg_inner") + F.col("_seg_b")).over(wc.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    out = join_on(local, summary.select(*keys, CHUNK, "_seg_carry", "_seg_b"), [*keys, CHUNK])
    return (out.withColumn(name, (F.col("_seg_carry") + F.col("_seg_b") + F.col("_seg_l")).cast("long"))
            .drop(CHUNK, "_seg_f", "_seg_l", "_seg_carry", "_seg_b"))


def run_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
            chunk: Column, name: str = "run_id") -> DataFrame:
    """Runs of equal consecutive ``value``s (NULL equals NULL) per key."""
    out = segment_ids(df.withColumn("_rv", value), keys, order, ["_rv"],
                      lambda p, c: ~p["_rv"].eqNullSafe(c["_rv"]), chunk, name)
    return out.drop("_rv")


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named columns where NULL keys match each other
    (``<=>``), like the grouping in the scans; ``right``'s key columns are
    dropped. Still a hash / sort-merge equi-join."""
    on = list(on)
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on],
                     *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        eq = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])

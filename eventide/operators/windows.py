"""Event-time windows: tumbling (S-4), sliding (S-5), per-window aggregates
(AGG-3, AGG-4, AGG-5, AGG-11), one record per window (AGG-6) and the
busiest window per session of windows (AGG-7).

Every function works on batch and streaming DataFrames alike (streaming
input needs ``withWatermark`` on the time column first, append mode).
Window bounds come out as epoch-ms BIGINT columns; ``keep_window=True``
keeps the ``window`` struct for chaining (``window_time``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.render import store_count_item
from eventide.functions.timefn import epoch_ms


def duration(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def window_column(time_col: str, size_ms: int, slide_ms: int | None = None) -> Column:
    """Epoch-aligned tumbling (no slide) or sliding window struct."""
    if slide_ms is None or slide_ms == size_ms:
        return F.window(time_col, duration(size_ms))
    return F.window(time_col, duration(size_ms), duration(slide_ms))


def window_aggregate(df: DataFrame, time_col: str, size_ms: int,
                     aggs: Sequence[Column], keys: Sequence[str] = (),
                     slide_ms: int | None = None, keep_window: bool = False) -> DataFrame:
    """``groupBy(keys, window).agg(aggs)``.

    Partial aggregation runs before the exchange, so a hot key or a busy
    window costs one row per task, not one row per event. Empty windows do
    not exist. Output: keys, ``window_start_ms``, ``window_end_ms``, aggs.
    """
    grouped = df.groupBy(*keys, window_column(time_col, size_ms, slide_ms).alias("window")).agg(*aggs)
    names = [c for c in grouped.columns if c not in set(keys) | {"window"}]
    cols = [*keys, epoch_ms("window.start").alias("window_start_ms"),
            epoch_ms("window.end").alias("window_end_ms"), *names]
    if keep_window:
        cols.append("window")
    return grouped.select(*cols)


def window_counts(df: DataFrame, time_col: str, size_ms: int, keys: Sequence[str] = (),
                  slide_ms: int | None = None, name: str = "n",
                  keep_window: bool = False) -> DataFrame:
    """AGG-3 / AGG-5: rows per (keys, window)."""
    return window_aggregate(df, time_col, size_ms, [F.count(F.lit(1)).alias(name)],
                            keys, slide_ms, keep_window)


def window_min_max(df: DataFrame, time_col: str, value: str, size_ms: int,
                   keys: Sequence[str] = (), slide_ms: int | None = None) -> DataFrame:
    """AGG-4: min and max of ``value`` per (keys, window), with the row count."""
    return window_aggregate(
        df, time_col, size_ms,
        [F.min(value).alias("min_value"), F.max(value).alias("max_value"),
         F.count(F.lit(1)).alias("n")],
        keys, slide_ms)


def window_min_time(df: DataFrame, time_col: str, size_ms: int,
                    keys: Sequence[str] = ()) -> DataFrame:
    """AGG-11: earliest event time per (keys, tumbling window)."""
    return window_aggregate(df, time_col, size_ms,
                            [F.min(time_col).alias("min_time"), F.count(F.lit(1)).alias("n")],
                            keys)


def counts_per_window_report(counts: DataFrame, key: str, n: str = "n",
                             as_map: bool = False) -> DataFrame:
    """AGG-6: one record per window with every ``key -> n`` of that window.

    Input is already aggregated per (window, key), so a window holds one
    entry per distinct key (a bounded domain such as stores), never one per
    event. Entries are sorted by key; ``report`` renders the reference line
    without its wall-clock prefix. ``as_map`` adds a MAP column.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(n).alias("v"))))
    grouped = counts.groupBy("window_start_ms", "window_end_ms").agg(entries.alias("_entries"))
    out = grouped.select(
        "window_start_ms", "window_end_ms",
        F.size("_entries").alias("n_keys"),
        F.aggregate("_entries", F.lit(0).cast("long"), lambda acc, x: acc + x["v"]).alias("n_total"),
        F.concat(F.lit("ERROR RATE "), F.array_join(
            F.transform("_entries", lambda x: store_count_item(x["k"], x["v"])), " ")).alias("report"),
        *([F.map_from_entries("_entries").alias("counts")] if as_map else []))
    return out

"""Event-time sessions (S-6, S-7).

``global_sessions`` finds sessions over all rows together (the reference's
``windowAll``) without sending all rows to one task. Rows are first reduced
to buckets of width ``gap``: two rows in one bucket are less than ``gap``
apart, so a bucket never splits between sessions. The bucket table (at most
time span / gap rows, partial-aggregated, so a hot instant costs nothing)
is then cut into sessions by ``segment_ids`` (gaps and islands): a bucket
starts a session when its first row is more than ``gap`` after the last row
of the previous non-empty bucket. Rows exactly ``gap`` apart belong to one session, like
Spark's ``session_window`` (session end = last row + gap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.timefn import epoch_us
from eventide.operators.scan import join_on, segment_ids
from eventide.session import materialize
from eventide.operators.windows import duration

BUCKETS_PER_CHUNK = 4096


def _bucket(us: Column, gap_us: int) -> Column:
    # exact for |us| < 2**53 (IEEE division is correctly rounded)
    return F.floor(us / F.lit(gap_us))


def _session_ids(buckets: DataFrame, gap_us: int, keys: Sequence[str]) -> DataFrame:
    """buckets(keys, _b, lo, hi, ...) -> adds ``_sid`` (1-based per key): a
    bucket opens a session when its first row is more than ``gap`` after
    the previous bucket's last row."""
    chunk = F.floor(F.col("_b") / F.lit(BUCKETS_PER_CHUNK))
    return segment_ids(buckets, keys, ["_b"], ["lo", "hi"],
                       lambda p, c: (c["lo"] - p["hi"]) > F.lit(gap_us), chunk, "_sid")


def global_sessions(df: DataFrame, time_col: str, gap_ms: int,
                    keys: Sequence[str] = (), count_name: str = "n") -> DataFrame:
    """Sessions with gap ``gap_ms`` over all rows (per ``keys`` if given).

    Output: keys, ``session_start_ms``, ``session_end_ms``, ``count_name``.
    """
    gap_us = gap_ms * 1000
    us = epoch_us(time_col)
    buckets = (df.select(*keys, us.alias("_us"))
               .groupBy(*keys, _bucket(F.col("_us"), gap_us).alias("_b"))
               .agg(F.min("_us").alias("lo"), F.max("_us").alias("hi"),
                    F.count(F.lit(1)).alias("_n")))
    # the rows are read once: the bucket table (<= span / gap rows per key)
    # is stored in the shared checkpoint folder for the passes over it
    buckets = materialize(buckets, "session-buckets")
    sessions = (_session_ids(buckets, gap_us, keys)
                .groupBy(*keys, "_sid")
                .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                     F.sum("_n").alias(count_name)))
    return sessions.select(
        *keys,
        F.unix_millis(F.timestamp_micros(F.col("lo"))).alias("session_start_ms"),
        F.unix_millis(F.timestamp_micros(F.col("hi") + F.lit(gap_us))).alias("session_end_ms"),
        count_name)


def assign_global_sessions(df: DataFrame, time_col: str, gap_ms: int,
                           keys: Sequence[str] = ()) -> DataFrame:
    """Tag every row with its session (``session_id``, ``session_start_ms``,
    ``session_end_ms``) for aggregates that are not decomposable per bucket
    (e.g. ``max_by``). The bucket-to-session map is joined back on
    (keys, bucket)."""
    gap_us = gap_ms * 1000
    tagged = df.withColumn("_us", epoch_us(time_col)).withColumn("_b", _bucket(F.col("_us"), gap_us))
    buckets = materialize(
        tagged.groupBy(*keys, "_b").agg(F.min("_us").alias("lo"), F.max("_us").alias("hi")),
        "session-buckets")
    sids = _session_ids(buckets, gap_us, keys)
    span = sids.groupBy(*keys, "_sid").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    sids = join_on(sids.select(*keys, "_sid", "_b"), span, [*keys, "_sid"]).select(
        *keys, "_b", F.col("_sid").alias("session_id"),
        F.unix_millis(F.timestamp_micros(F.col("_lo"))).alias("session_start_ms"),
        F.unix_millis(F.timestamp_micros(F.col("_hi") + F.lit(gap_us))).alias("session_end_ms"))
    return join_on(tagged, sids, [*keys, "_b"]).drop("_us", "_b")


def keyed_sessions(df: DataFrame, time_col: str, gap_ms: int, keys: Sequence[str],
                   count_name: str = "n") -> DataFrame:
    """Sessions per key with Spark's ``session_window`` (batch or streaming)."""
    grouped = df.groupBy(*keys, F.session_window(time_col, duration(gap_ms)).alias("session")).agg(
        F.count(F.lit(1)).alias(count_name))
    return grouped.select(*keys, F.unix_millis("session.start").alias("session_start_ms"),
                          F.unix_millis("session.end").alias("session_end_ms"), count_name)


def busiest_window(df: DataFrame, time_col: str, size_ms: int, slide_ms: int,
                   session_gap_ms: int, count_name: str = "click_count") -> DataFrame:
    """AGG-7 over S-5 and S-7: count rows per sliding window (all rows
    together), put the window results into event-time sessions of gap
    ``session_gap_ms`` (a window's time is ``window_time`` = end - 1 us), and
    keep per session the window with the most rows; a tie keeps the earlier
    window. Output: ``w_start_ms``, ``w_end_ms``, ``count_name``."""
    from eventide.operators.windows import window_counts

    counts = (window_counts(df, time_col, size_ms, slide_ms=slide_ms, name=count_name,
                            keep_window=True)
              .withColumn("_wt", F.window_time("window")).drop("window"))
    # one row per window; read twice below (bucket table and rows)
    counts = materialize(counts, "window-counts")
    tagged = assign_global_sessions(counts, "_wt", session_gap_ms)
    best = tagged.groupBy("session_id").agg(
        F.max_by(F.struct("window_start_ms", "window_end_ms", count_name),
                 F.struct(F.col(count_name), -F.col("window_start_ms"))).alias("_best"))
    return best.select(F.col("_best.window_start_ms").alias("w_start_ms"),
                       F.col("_best.window_end_ms").alias("w_end_ms"),
                       F.col(f"_best.{count_name}").alias(count_name))

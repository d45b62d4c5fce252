"""Streaming forms of the jobs. Built-in stateful operators (windowed
aggregates, session windows, stream-stream joins, dedup within watermark)
where they fit; ``transformWithState`` processors where they do not.
All run in append mode with event-time watermarks, except the quiet report
(processing time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide import constants as K
from eventide.functions.predicates import is_late
from eventide.functions.timefn import micros_between
from eventide.functions.text import explode_tokens
from eventide.operators import windows
from eventide.operators.joins import BEFORE_ORDER, IN_TIME, LATE, UNMATCHED
from eventide.session import python_workers_can_import
from eventide.streaming.processors import (
    PeriodChangeProcessor, PreviousValueProcessor, QuietReportProcessor, SessionMergeProcessor, ThresholdBatchProcessor)

#: Parts that the keys of ``click_jumps`` are dealt over.
KEY_PARTS = 128

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _prepare(stream: DataFrame) -> None:
    """Processors run in Python workers and keep state in RocksDB (the
    only state store ``transformWithState`` supports): ship the package and
    select the provider for queries started from this session."""
    spark = stream.sparkSession
    # the driver-side runner of transformWithState does not see addPyFile:
    # processor classes are pickled by value
    python_workers_can_import(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != _ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


def _type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def in_event_order(stream: DataFrame, keys: Sequence[str], time_col: str, columns: Sequence[str],
                   bucket_ms: int = K.COMMENT_WINDOW_MS) -> DataFrame:
    """S-13: the rows of a watermarked stream, held back until the watermark has passed them.

    Rows wait in windows of ``bucket_ms`` per key, one state entry each (the built-in windowed
    aggregate); a window that the watermark has passed comes out and leaves the state, so every
    row is stored and read once. The windows that come out in a micro-batch are later than all before, so a
    chained stateful stage that sorts the rows of each micro-batch sees them in event order. A row whose window has
    come out is late and dropped (S-10); a row without a time is dropped too. The rows of a key in one window are one
    state entry: choose ``bucket_ms`` so that it fits a task."""
    fields = [c for c in dict.fromkeys(columns) if c not in keys]
    held = stream.groupBy(*keys, windows.window_column(time_col, bucket_ms).alias("_bucket")).agg(
        F.collect_list(F.struct(*fields)).alias("_rows"))
    return held.select(*keys, F.inline("_rows"))


def article_counts(stream: DataFrame, text: str = "text") -> DataFrame:
    """Q1 streaming (AGG-1): running counts of "the" and "a". Run in
    ``update`` mode: one updated count per token and micro-batch (not per
    row, as the reference's rolling reduce would); partial aggregation runs
    before the state store."""
    toks = explode_tokens(stream, text, keep=K.ARTICLES)
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def language_concat(stream: DataFrame, key: str = "language", order: str = "ord",
                    token: str = "token") -> DataFrame:
    """Q2 streaming (AGG-2): per key, the tokens so far concatenated in
    ``order``; ``update`` or ``complete`` mode. The state holds the key's
    tokens (the result is as long as the input by definition)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(token).alias("_t"))))
    return stream.groupBy(key).agg(F.array_join(F.transform(items, lambda x: x["_t"]), "").alias("text"))


def click_jumps(stream: DataFrame, key: str, order: Sequence[str], value: str,
                keep: Sequence[str], min_diff: int = K.MIN_CLICK_JUMP,
                last_name: str = "last_value", event_time: str | None = None,
                bucket_ms: int = K.COMMENT_WINDOW_MS, ttl_ms: int | None = None, parts: int = KEY_PARTS) -> DataFrame:
    """Q5 streaming: keyed value state (S-11) in arrival order; with
    ``event_time`` (a watermarked column) in event order (S-13, see ``in_event_order``). ``ttl_ms``: a key
    without rows for so long (processing time) leaves the state and starts anew. The keys are dealt over
    ``parts`` by hash; one call of the processor takes a part's rows of a micro-batch, so choose more parts for larger
    micro-batches. The number belongs to the state: a restarted query must keep it."""
    fields = [key, *keep, value]
    schema = ", ".join(f"{c} {_type_of(stream, c)}" for c in fields) + f", {last_name} bigint"
    _prepare(stream)
    if event_time:
        stream = in_event_order(stream, [key], event_time, [*order, *keep, value], bucket_ms)
    proc = PreviousValueProcessor(key, _type_of(stream, key), order, value, keep, min_diff, last_name, ttl_ms)
    stream = stream.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)))
    return stream.groupBy("_part").transformWithStateInPandas(proc, schema, "Append", "ProcessingTime" if ttl_ms else "None")


def store_batches(stream: DataFrame, key: str, order: Sequence[str], kind: str, app: str,
                  install_threshold: int = K.INSTALL_THRESHOLD,
                  uninstall_threshold: int = K.UNINSTALL_THRESHOLD,
                  top_n: int = K.TOP_APPS, event_time: str | None = None,
                  bucket_ms: int = K.COMMENT_WINDOW_MS) -> DataFrame:
    """Q6 streaming: counters in value state, per-app counts in map state
    (S-11, S-12), in arrival order or with ``event_time`` in event order; the side
    output of errors is a filter before it."""
    schema = (f"{key} {_type_of(stream, key)}, batch_no bigint, kind string, rank bigint, "
              f"app string, n bigint")
    _prepare(stream)
    if event_time:
        stream = in_event_order(stream, [key], event_time, [*order, kind, app], bucket_ms)
    proc = ThresholdBatchProcessor(key, order, kind, app, install_threshold, uninstall_threshold, top_n)
    return stream.groupBy(key).transformWithStateInPandas(proc, schema, "Append", "None")


def error_windows(stream: DataFrame, time_col: str, key: str,
                  size_ms: int = K.ERROR_REPORT_MS) -> DataFrame:
    """Q7 streaming: tumbling window counts (append: emitted once the
    watermark passes the window end). Needs ``withWatermark`` upstream."""
    return windows.window_counts(stream, time_col, size_ms, keys=[key])


def acronym_periods(stream: DataFrame, topic: str, time_col: str, acronym: str,
                    window_ms: int = K.COMMENT_WINDOW_MS, top_n: int = K.TOP_ACRONYMS) -> DataFrame:
    """Q8 streaming: a windowed partial aggregate per (topic, window,
    acronym) feeds the period state machine (S-15: window -> state)."""
    _prepare(stream)
    agg = stream.groupBy(topic, windows.window_column(time_col, window_ms).alias("w"), acronym).agg(
        F.count(F.lit(1)).alias("n"), F.min(time_col).alias("_min_t"))
    rows = agg.select(topic, F.unix_millis("w.start").alias("window_start_ms"), acronym, "n",
                      F.unix_millis("_min_t").alias("min_time_ms"))
    schema = (f"{topic} {_type_of(stream, topic)}, acronym string, acronyms_counter bigint, "
              "total_comments_counter bigint, label_time_of_day string, closed_at_ms bigint, "
              "period_time_of_day string")
    return rows.groupBy(topic).transformWithStateInPandas(PeriodChangeProcessor(topic, top_n), schema,
                                                          "Append", "None")


def click_sessions(stream: DataFrame, time_col: str, gap_ms: int = K.SESSION_GAP_MS,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Q3 streaming (S-6): event-time sessions, with ``keys`` by ``session_window``, without over all
    rows together in two chained stages. The first counts rows in buckets as wide as the gap (a windowed
    aggregate, partial before the shuffle, dealt by bucket); rows of one bucket are in one session. The second
    merges closed buckets, at most span / gap short rows, whatever the number of clicks."""
    if keys:
        grouped = stream.groupBy(*keys, F.session_window(time_col, windows.duration(gap_ms)).alias("s")).agg(
            F.count(F.lit(1)).alias("clicks"))
        return grouped.select(*keys, F.unix_millis("s.start").alias("session_start_ms"),
                              F.unix_millis("s.end").alias("session_end_ms"), "clicks")
    _prepare(stream)
    us = F.unix_micros(time_col)
    buckets = stream.groupBy(windows.window_column(time_col, gap_ms).alias("bucket")).agg(
        F.min(us).alias("lo"), F.max(us).alias("hi"), F.count(F.lit(1)).alias("n"))
    merged = buckets.withColumn("_all", F.lit(0)).groupBy("_all").transformWithStateInPandas(
        SessionMergeProcessor("_all", gap_ms * 1000), "_all int, start_us bigint, last_us bigint, n bigint", "Append", "EventTime")
    return merged.select(F.unix_millis(F.timestamp_micros("start_us")).alias("session_start_ms"),
                         F.unix_millis(F.timestamp_micros(F.col("last_us") + F.lit(gap_ms * 1000))).alias("session_end_ms"),
                         F.col("n").alias("clicks"))


def busiest_window(stream: DataFrame, time_col: str, size_ms: int = K.SLIDING_SIZE_MS,
                   slide_ms: int = K.SLIDING_SLIDE_MS,
                   gap_ms: int = K.BUSIEST_SESSION_GAP_MS) -> DataFrame:
    """Q9 streaming: sliding counts chained into an event-time session over
    ``window_time`` (S-7, S-15). A global session needs a key column in
    streaming, so a constant one is added; its input is one row per window."""
    counts = windows.window_counts(stream, time_col, size_ms, slide_ms=slide_ms, name="click_count",
                                   keep_window=True)
    counts = counts.withColumn("_all", F.lit(0))
    best = counts.groupBy("_all", F.session_window(F.window_time("window"),
                                                   windows.duration(gap_ms))).agg(
        F.max_by(F.struct("window_start_ms", "window_end_ms", "click_count"),
                 F.struct(F.col("click_count"), -F.col("window_start_ms"))).alias("_b"))
    return best.select(F.col("_b.window_start_ms").alias("w_start_ms"),
                       F.col("_b.window_end_ms").alias("w_end_ms"),
                       F.col("_b.click_count").alias("click_count"))


def first_arrivals(stream: DataFrame, key: str) -> DataFrame:
    """AGG-8 streaming: the first row to arrive per ``key``; repeats within the watermark's delay of
    it are dropped (``dropDuplicatesWithinWatermark``), and the key leaves the state when the watermark has
    passed that time. Of repeats within one micro-batch that differ, any one may be the first."""
    return stream.dropDuplicatesWithinWatermark([key])


def delivery_matches(orders: DataFrame, deliveries: DataFrame, order_key: str, order_ts: str,
                     order_ref: str, delivery_ts: str, after_days: int = 30, before_days: int = 1,
                     late_after_s: int = K.LATE_AFTER_SECONDS, first: str = "earliest") -> DataFrame:
    """J-2 streaming: each delivery with the first order of its id (AGG-8), whichever side comes first and
    however often an order is repeated.

    A left outer stream-stream join keeps orders for ``after_days`` and waits
    ``before_days`` for an order later than its delivery (``before_order``). A delivery without an order
    within these bounds is ``unmatched``: a stream cannot tell an order that
    never existed from one outside the bounds. Equal rows are deliveries of their own.
    Both inputs need ``withWatermark``.

    ``first="arrival"``, as in the reference: repeats of an order are dropped before the join
    (``first_arrivals``), so the join state holds each once and a delivery comes out as soon as it
    is matched. ``first="earliest"``, as in batch: all repeats are joined, and an aggregate per delivery keeps the earliest
    when the watermark has passed the waiting time."""
    if first not in ("earliest", "arrival"):
        raise ValueError(first)
    span = lambda days: F.expr(f"INTERVAL {int(days)} DAYS")
    cond = ((F.col(order_ref) == F.col(order_key))
            & (F.col(order_ts) >= F.col(delivery_ts) - span(after_days))
            & (F.col(order_ts) <= F.col(delivery_ts) + span(before_days)))
    orders = orders.select(order_key, order_ts)
    if first == "arrival":
        matched = deliveries.join(first_arrivals(orders, order_key), cond, "leftOuter")
    else:
        marked = deliveries.withColumn("_delivery", F.expr("uuid()"))
        matched = marked.join(orders, cond, "leftOuter").groupBy(*marked.columns).agg(F.min(order_ts).alias(order_ts))
    lateness = micros_between(order_ts, delivery_ts)
    status = (F.when(F.col(order_ts).isNull(), F.lit(UNMATCHED)).when(lateness < 0, F.lit(BEFORE_ORDER))
              .when(is_late(lateness, late_after_s), F.lit(LATE)).otherwise(F.lit(IN_TIME)))
    return matched.select(*deliveries.columns, F.col(order_ts), lateness.alias("lateness_us"),
                          status.alias("status"))


def quiet_report(stream: DataFrame, key: str, status: str,
                 gap_ms: int = K.QUIET_GAP_SECONDS * 1000) -> DataFrame:
    """S-8: per ``key``, status counts emitted after ``gap_ms`` of
    processing time without input. Use a salted key for volume and sum the
    partial reports downstream."""
    _prepare(stream)
    schema = f"{key} {_type_of(stream, key)}, status string, n bigint"
    return stream.groupBy(key).transformWithStateInPandas(QuietReportProcessor(key, status, gap_ms), schema,
                                                          "Append", "ProcessingTime")

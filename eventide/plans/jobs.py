"""The reference's ten jobs on their own input shapes, composed from the
operators. Inputs are DataFrames (batch, or streaming where noted); the
reference's constants are the defaults of every parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide import constants as K
from eventide.functions.render import min_max_line, window_count_line
from eventide.functions.text import article_flag, explode_tokens
from eventide.functions.timefn import parse_instant, rebase_ms
from eventide.operators import joins, periods, quality, rolling, segments, sessions, windows


def article_counts(texts: DataFrame, running: bool = False) -> DataFrame:
    """Q1: counts of "the" and "a" in (ord, text). Keyed by ``is_a`` like the
    reference; ``running`` gives one row per token occurrence."""
    toks = explode_tokens(texts, "text", keep=K.ARTICLES, pos_col="pos")
    toks = toks.withColumn("is_a", article_flag("token"))
    if running:
        return rolling.running_counts(toks, ["is_a"], ["ord", "pos"], name="count")
    return toks.groupBy("is_a").agg(F.first("token").alias("token"),
                                    F.count(F.lit(1)).alias("count")).drop("is_a")


def language_concat(tokens: DataFrame, running: bool = False) -> DataFrame:
    """Q2: per language, tokens concatenated in arrival order (ord)."""
    if running:
        return rolling.running_concat(tokens, ["language"], ["ord"], "token", name="text")
    return rolling.ordered_concat(tokens, ["language"], ["ord"], "token", name="text")


def click_sessions(clicks: DataFrame, gap_ms: int = K.SESSION_GAP_MS,
                   with_line: bool = False) -> DataFrame:
    """Q3: clicks per session, all users together (``line``: the report text)."""
    out = sessions.global_sessions(clicks, "click_time", gap_ms, count_name="clicks")
    if with_line:
        out = out.withColumn("line", window_count_line("session_start_ms", "session_end_ms", "clicks"))
    return out


def booking_min_max(bookings: DataFrame, size_ms: int = K.SLIDING_SIZE_MS,
                    slide_ms: int = K.SLIDING_SLIDE_MS, with_line: bool = False) -> DataFrame:
    """Q4: min and max bookings per region and sliding window."""
    out = windows.window_min_max(bookings, "event_time", "booking_count", size_ms,
                                 keys=["geo_region"], slide_ms=slide_ms)
    if with_line:
        out = out.withColumn("line", min_max_line("geo_region", "window_start_ms", "window_end_ms",
                                                  "min_value", "max_value"))
    return out


def click_jumps(clicks: DataFrame, min_diff: int = K.MIN_CLICK_JUMP,
                order: tuple = ("time", "ord")) -> DataFrame:
    """Q5: per user, clicks whose count is 0 or rose by more than ``min_diff``
    (``order`` is arrival order: time, then a tie-breaker)."""
    return rolling.previous_jump(clicks, ["user_id"], list(order), "click_count",
                                 min_diff=min_diff, last_name="last_clicks_count")


def store_reports(store_events: DataFrame, install_threshold: int = K.INSTALL_THRESHOLD,
                  uninstall_threshold: int = K.UNINSTALL_THRESHOLD, top_n: int = K.TOP_APPS,
                  report_ms: int = K.ERROR_REPORT_MS, order: tuple = ("event_time", "ord"),
                  ) -> tuple[DataFrame, DataFrame]:
    """Q6 + Q7 from one stream: ``(top_apps_per_batch, errors_per_window)``.
    Errors go to the side output; the rest form count-driven batches."""
    main, side = quality.split(store_events, F.col("event_type") == F.lit(K.EVENT_ERROR))
    tagged = segments.assign_batches(main, "store", list(order), "event_type",
                                     install_threshold=install_threshold,
                                     uninstall_threshold=uninstall_threshold)
    top = segments.top_apps(segments.app_counts(tagged, "store", "app_id"), "store", "app_id", top_n)
    errors = windows.counts_per_window_report(
        windows.window_counts(side, "event_time", report_ms, keys=["store"]), "store")
    return top, errors


def acronym_periods(comments: DataFrame, window_ms: int = K.COMMENT_WINDOW_MS,
                    top_n: int = K.TOP_ACRONYMS, with_label: bool = True,
                    rebase: bool = True) -> DataFrame:
    """Q8 / Q8': comments (commentId, time ms offset, user, topic, acronim)
    rebased onto t0, then top acronyms of each finished time-of-day period."""
    rows = comments.select("topic", F.col("acronim").alias("acronym"),
                           (rebase_ms("time") if rebase else F.col("time")).alias("time"))
    return periods.period_top_acronyms(rows, "topic", "time", "acronym", window_ms, top_n,
                                       with_label)


def busiest_window(clicks: DataFrame, size_ms: int = K.SLIDING_SIZE_MS,
                   slide_ms: int = K.SLIDING_SLIDE_MS,
                   gap_ms: int = K.BUSIEST_SESSION_GAP_MS) -> DataFrame:
    """Q9: per 30 s session of 2 s/1 s windows, the window with most clicks."""
    return sessions.busiest_window(clicks, "click_time", size_ms, slide_ms, gap_ms)


def delivery_report(orders: DataFrame, deliveries: DataFrame,
                    late_after_s: int = K.LATE_AFTER_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Q10: ``(classified deliveries, summary)``. Orders (id, order_time ISO),
    deliveries (id, order_id, delivery_time ISO)."""
    o = orders.select(F.col("id").alias("order_key"), parse_instant("order_time").alias("order_ts"))
    d = deliveries.select(F.col("id").alias("delivery_id"), "order_id",
                          parse_instant("delivery_time").alias("delivery_ts"))
    classified = joins.classify_deliveries(d, o, "order_id", "order_key", "order_ts",
                                           "delivery_ts", late_after_s)
    return classified, joins.lateness_summary(classified)

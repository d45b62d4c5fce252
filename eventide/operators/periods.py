"""Periods of equal time of day per topic (W-3, W-4, W-5, AGG-12, K-2, F-9).

Per topic, rows are pre-batched into epoch-aligned tumbling windows. A
window's label is the time of day of its earliest row. Consecutive
non-empty windows with the same label form a *period* (gaps and islands:
a new period starts where the label differs from the previous non-empty
window's). A period is reported when the next one starts: per acronym its
count, the period's row total, the next period's label and the earliest time
of its first window (the reference's ``label_time_of_day`` / ``closed_at``),
plus the period's own label (``period_time_of_day``). The open last period
of a topic is not reported. Only the top ``top_n`` acronyms (count desc,
acronym asc) of a period are kept.

Plan: two partial aggregates (per topic/window/acronym and per
topic/window), a gaps-and-islands pass over the window table (one row per
non-empty window, never per row) to number periods, an equi-join of period ``p`` to
``p + 1`` for the successor, and a top-n window over (topic, period).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.constants import COMMENT_WINDOW_MS, TOP_ACRONYMS
from eventide.functions.timefn import epoch_us, time_of_day
from eventide.operators.scan import join_on, run_ids
from eventide.session import materialize

WINDOWS_PER_CHUNK = 8640


def window_acronym_counts(df: DataFrame, topic: str, time_col: str, acronym: str,
                          window_ms: int = COMMENT_WINDOW_MS) -> DataFrame:
    """Pre-batching (AGG-5, AGG-11): per (topic, tumbling window, acronym)
    the count and earliest time; partial aggregation before the shuffle."""
    width = window_ms * 1000
    rows = df.select(topic, acronym, epoch_us(time_col).alias("_us"))
    return (rows.groupBy(topic, F.floor(F.col("_us") / F.lit(width)).alias("_w"), acronym)
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_min_us")))


def window_labels(per_acr: DataFrame, topic: str) -> DataFrame:
    """Per (topic, window): earliest time, row total and its time-of-day label."""
    return (per_acr.groupBy(topic, "_w")
            .agg(F.min("_min_us").alias("_min_us"), F.sum("_n").alias("_total"))
            .withColumn("_label", time_of_day(F.timestamp_micros(F.col("_min_us")))))


def number_periods(per_win: DataFrame, topic: str) -> DataFrame:
    """W-3: ``_period`` (1-based per topic) for every non-empty window: the
    run id of equal consecutive labels (gaps and islands, ``run_ids``)."""
    chunk = F.floor(F.col("_w") / F.lit(WINDOWS_PER_CHUNK))
    return run_ids(per_win, [topic], ["_w"], F.col("_label"), chunk, "_period")


def period_top_acronyms(df: DataFrame, topic: str, time_col: str, acronym: str,
                        window_ms: int = COMMENT_WINDOW_MS, top_n: int = TOP_ACRONYMS,
                        with_label: bool = True) -> DataFrame:
    """Finished periods with their top acronyms. Output columns: topic,
    acronym, ``acronyms_counter``, ``total_comments_counter``,
    ``label_time_of_day`` (next period's label; omitted when
    ``with_label`` is False), ``closed_at_ms`` and ``period_time_of_day``."""
    # The rows are read once: the per-(topic, window, acronym) aggregate is
    # stored in the shared checkpoint folder (at most one row per input row)
    # and every later step reads it; run_ids stores its window pass itself.
    per_acr = materialize(window_acronym_counts(df, topic, time_col, acronym, window_ms),
                          "periods-acronyms")
    wins = number_periods(window_labels(per_acr, topic), topic)
    periods = wins.groupBy(topic, "_period").agg(
        F.min("_min_us").alias("_first_us"), F.sum("_total").alias("_total"),
        F.first("_label").alias("_label"))
    successor = periods.select(topic, (F.col("_period") - 1).alias("_period"),
                               F.col("_label").alias("label_time_of_day"),
                               F.unix_millis(F.timestamp_micros(F.col("_first_us"))).alias("closed_at_ms"))
    finished = join_on(periods, successor, [topic, "_period"]).select(
        topic, "_period", F.col("_total").cast("long").alias("total_comments_counter"),
        F.col("_label").alias("period_time_of_day"), "label_time_of_day", "closed_at_ms")

    counts = (join_on(per_acr, wins.select(topic, "_w", "_period"), [topic, "_w"])
              .groupBy(topic, "_period", acronym).agg(F.sum("_n").cast("long").alias("acronyms_counter")))
    rank = Window.partitionBy(topic, "_period").orderBy(F.desc("acronyms_counter"), F.asc(acronym))
    top = counts.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= top_n)
    out = join_on(top, finished, [topic, "_period"]).select(
        topic, acronym, "acronyms_counter", "total_comments_counter",
        "label_time_of_day", "closed_at_ms", "period_time_of_day")
    return out if with_label else out.drop("label_time_of_day")

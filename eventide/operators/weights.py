"""Weighted category assignment (R-1): the first item whose cumulative
weight reaches ``p`` (inverse CDF); ``p`` is a column in [0, 1].

The weight table is a configuration of at most ``MAX_ITEMS`` entries; a
larger one is refused. Its intervals are bucketed on ``p`` and joined on the
bucket (an equi-join with the broadcast table), then filtered to the exact
interval. Neighbouring intervals share their bound, so every p finds
exactly one item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.constants import GENERATOR_WEIGHTS

MAX_ITEMS = 100_000
P_BUCKETS = 1024
TOLERANCE = 1e-9


def weights_frame(spark: SparkSession, weights: dict = GENERATOR_WEIGHTS) -> DataFrame:
    """``(dimension, pos, name, probability)`` rows from a weight mapping."""
    rows = [F.struct(F.lit(dim).alias("dimension"), F.lit(pos).alias("pos"), F.lit(name).alias("name"), F.lit(float(p)).alias("probability"))
            for dim, items in weights.items() for pos, (name, p) in enumerate(items)]
    if not rows:
        return spark.createDataFrame([], "dimension string, pos int, name string, probability double")
    return spark.range(1).select(F.inline(F.array(*rows)))


def intervals(weights: DataFrame, dimension: str) -> DataFrame:
    """``(_lo, _hi]`` per item of one dimension: ``_lo`` is the cumulative sum
    up to the item before (-1 for the first, which also takes p = 0). The last
    item's ``_hi`` is 1, whatever the rounding of the sum. Fails (VAL-4) when
    the weights do not add up to 1 or one of them is missing or negative."""
    whole = Window.partitionBy("dimension")
    w = whole.orderBy("pos")
    rows = weights.filter(F.col("dimension") == dimension)
    bad = F.coalesce(F.max(F.col("probability").isNull() | (F.col("probability") < 0)).over(whole), F.lit(True))
    rows = (rows.withColumn("_total", F.sum("probability").over(whole)).withColumn("_bad", bad)
            .withColumn("_sum", F.sum("probability").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    rows = rows.withColumn("_hi", F.when(F.lead("pos").over(w).isNull(), F.lit(1.0)).otherwise(F.least("_sum", F.lit(1.0))))
    rows = rows.withColumn("_lo", F.lag("_hi", 1, -1.0).over(w))
    valid = F.coalesce(~F.col("_bad") & (F.abs(F.col("_total") - 1) <= TOLERANCE), F.lit(False))
    return (rows.filter(F.assert_true(valid, F.lit(f"weights of {dimension} do not add up to 1")).isNull())
            .select("pos", "name", "_lo", "_hi"))


def assign(df: DataFrame, p: str, weights: DataFrame, dimension: str, out: str) -> DataFrame:
    """Add column ``out`` = item of ``dimension`` drawn by column ``p``; NULL
    for a p that is NULL or outside [0, 1].

    An equi-join on a p-bucket, then the exact interval test: each item is
    listed once per bucket its interval overlaps (at most items + buckets
    rows), so no row is compared with every item.
    """
    items = weights.filter(F.col("dimension") == dimension).limit(MAX_ITEMS + 1).count()
    if not 0 < items <= MAX_ITEMS:
        raise ValueError(f"{dimension}: expected 1 to {MAX_ITEMS} weights")
    iv = intervals(weights, dimension)
    lo_b = F.floor(F.greatest(F.col("_lo"), F.lit(0.0)) * P_BUCKETS).cast("long")
    hi_b = F.floor(F.col("_hi") * P_BUCKETS).cast("long")
    iv_b = F.broadcast(iv.withColumn("_ibk", F.explode(F.sequence(lo_b, hi_b))))
    left = df.withColumn("_bk", F.floor(F.col(p) * P_BUCKETS).cast("long"))
    cond = ((left["_bk"] == iv_b["_ibk"]) & (left[p] > iv_b["_lo"]) & (left[p] <= iv_b["_hi"]))
    joined = left.join(iv_b, cond, "left")
    return joined.drop("_bk", "_ibk", "pos", "_lo", "_hi").withColumnRenamed("name", out)

"""Order / delivery matching (J-1, J-3, AGG-8, AGG-9, AGG-10, F-6, P-11).

Batch form: keep the first order per id (an aggregate, so a duplicated hot
id is reduced map-side), then one left join of deliveries to orders on the
order id. Catalyst/AQE pick broadcast or sort-merge from the measured size,
and AQE's skew-join split handles an order id that holds many deliveries.
Every delivery gets exactly one status: ``in_time``, ``late`` (strictly
more than the deadline), ``before_order`` (invalid) or ``orphan`` (no order).
The streaming form is in ``eventide.streaming.jobs``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.constants import LATE_AFTER_SECONDS
from eventide.functions.predicates import is_late
from eventide.functions.timefn import micros_between
from eventide.operators.quality import require

IN_TIME, LATE, BEFORE_ORDER, ORPHAN = "in_time", "late", "before_order", "orphan"
UNMATCHED = "unmatched"   # streaming only: no order within the join's bounds


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """AGG-8: the earliest row per key along ``order`` (add a tie-breaker).
    A partial aggregate: duplicates collapse before the shuffle. When the
    row is just its order column, plain ``min`` keeps it a hash aggregate
    (struct buffers force a sort-based aggregate)."""
    others = [c for c in df.columns if c != key]
    if len(order) == 1 and others == list(order):
        return df.groupBy(key).agg(F.min(order[0]).alias(order[0]))
    first = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in others])


def classify_deliveries(deliveries: DataFrame, orders: DataFrame, order_ref: str,
                        order_id: str, order_time: str, delivery_time: str,
                        late_after_s: int = LATE_AFTER_SECONDS) -> DataFrame:
    """J-1: each delivery with its (first) order, ``lateness_us``,
    ``deadline_s`` and ``status``. ``orders`` needs (order_id, order_time)."""
    first = first_per_key(orders.select(order_id, order_time), order_id, [order_time])
    joined = deliveries.join(first, deliveries[order_ref] == first[order_id], "left")
    lateness = micros_between(order_time, delivery_time)
    status = (F.when(F.col(order_id).isNull(), F.lit(ORPHAN))
              .when(lateness < 0, F.lit(BEFORE_ORDER))
              .when(is_late(lateness, late_after_s), F.lit(LATE))
              .otherwise(F.lit(IN_TIME)))
    return joined.select(*deliveries.columns, F.col(order_time),
                         lateness.alias("lateness_us"),
                         F.lit(late_after_s).cast("long").alias("deadline_s"),
                         status.alias("status"))


def lateness_summary(classified: DataFrame) -> DataFrame:
    """AGG-9: one row of counters (a global partial aggregate)."""
    s = F.col("status")
    return classified.agg(*[F.count_if(s == F.lit(v)).alias(v)
                            for v in (IN_TIME, LATE, BEFORE_ORDER, ORPHAN)])


def orphans(deliveries: DataFrame, orders: DataFrame, order_ref: str, order_id: str) -> DataFrame:
    """J-3 / VAL-1: deliveries whose order does not exist (anti join)."""
    ids = orders.select(F.col(order_id).alias("_oid"))
    return deliveries.join(ids, deliveries[order_ref] == ids["_oid"], "left_anti")


def require_orders(classified: DataFrame) -> DataFrame:
    """Strict form of J-3 / VAL-2: fail the job on an orphan or a delivery
    before its order (the reference throws)."""
    return require(classified, ~F.col("status").isin(ORPHAN, BEFORE_ORDER),
                   F.concat(F.lit("invalid delivery: "), F.coalesce("status", F.lit("NULL"))))

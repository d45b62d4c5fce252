"""Plan-shape guards for the scale properties (pushdown, pruning, chunked
exchanges, hash aggregation, no Python in batch queries)."""

import pytest

from eventide.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark):
    side = _plan(catalog.REGISTRY["split_side"].run(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in side
    mm = _plan(catalog.REGISTRY["sliding_min_max"].run(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in mm


def test_chunked_scan_spreads_hot_keys(spark):
    # two keys only ("the", "a"): the ordered window is partitioned by
    # (chunk, token), not by token alone
    plan = _plan(catalog.REGISTRY["article_running"].run(spark, SF))
    assert "hashpartitioning(_scan_chunk" in plan


def test_order_dedup_is_hash_aggregate(spark):
    plan = _plan(catalog.REGISTRY["delivery_lateness"].run(spark, SF))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


#: The threshold plan goes through chunks in Arrow batches (``operators/segments.py``).
IN_ARROW = {"threshold_batches", "threshold_batches_doubling", "threshold_top_apps", "threshold_report"}


def _plans_run(spark, work) -> str:
    """The plans of all jobs that ``work`` runs, those of stored intermediates included."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = store.executionsList(before, store.executionsCount() - before)
    return "\n".join(found.apply(i).physicalPlanDescription() for i in range(found.size()))


@pytest.mark.parametrize("name", [n for n in catalog.REGISTRY if not n.startswith("stream_")])
def test_batch_queries_stay_in_the_jvm(spark, name):
    plans = _plans_run(spark, lambda: catalog.REGISTRY[name].run(spark, SF).write.format("noop").mode("overwrite").save())
    assert "Scan" in plans
    used = {node for node in ("Python", "Pandas", "Arrow") if node in plans}
    assert used == ({"Arrow"} if name in IN_ARROW else set()), name

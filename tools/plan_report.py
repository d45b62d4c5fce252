"""Print the formatted physical plan of registered queries.

usage: python tools/plan_report.py [sf_dir] [name ...]
Defaults: sf0.01, every batch query. For each plan, a one-line summary
lists the parquet scans, exchanges, single-partition exchanges and Python
nodes, so the scale properties can be reviewed at a glance.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from eventide.plans import catalog
    from eventide.session import build_session

    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or [n for n in catalog.REGISTRY if not n.startswith("stream_")]:
        df = catalog.REGISTRY[name].run(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        summary = {k: plan.count(k) for k in ("FileScan", "Exchange", "SinglePartition",
                                             "BroadcastExchange", "FlatMapGroupsInPandas")}
        print(f"===== {name} {summary}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

"""Largest task per plan, from Spark's event log: does a hot key end up in one task?

Usage: python tools/skew_report.py [sf_dir]
Runs the hot-key session rollup and first touch (orders in status 'P' share one NULL key: about a
third of all rows) with the rewritten operators and with the source-shaped window plans, and prints
for each the largest number of shuffle records any single task read, next to the input row count.
AQE is on, with its skew thresholds scaled down to the test size.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def max_task_records(log_dir: str, group: str) -> int:
    jobs, stages, best = set(), set(), 0
    for path in [p for p in glob.glob(os.path.join(log_dir, "**"), recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            events = [json.loads(line) for line in fh]
        for e in events:
            if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
                jobs.add(e["Job ID"])
                stages.update(e["Stage IDs"])
        for e in events:
            if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                m = e.get("Task Metrics") or {}
                best = max(best, m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
    return best


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="caretrail-events-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "64").config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             # skew thresholds scaled down to the test size, so AQE's join splitting shows here
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
             .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from caretrail.operators.first_touch import first_touch
    from caretrail.operators.sessions import sessionize
    from tools import naive
    # Spread the (single-file) input over 16 map tasks, as a multi-file scan would be: AQE splits a
    # skewed join partition along map-task boundaries.
    orders = spark.read.parquet(f"{root}/orders.parquet").repartition(16).select(
        "o_orderkey", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    n = orders.count()
    hot = orders.where("k is null").count()
    plans = {
        "rewritten": lambda: sessionize(orders, "k", "o_orderdate", (15,), tiebreak=["o_orderkey"],
                                        tiebreak_unique=True, first_ts_fmt="first_{gap}",
                                        group_count_fmt="cnt_{gap}", firsts={"prio_{gap}": "o_orderpriority"}),
        "naive": lambda: naive.rollups_naive(
            naive.sessions_naive(orders, "k", "o_orderdate", (15,), tiebreak=["o_orderkey"]),
            "client_15", "o_orderdate", {"prio_15": "o_orderpriority"}, tiebreak=["o_orderkey"],
            first_ts_name="first_15", count_name="cnt_15"),
    }
    plans["first_touch_rewritten"] = lambda: first_touch(orders, ["k"], ["o_orderdate"], {"f": "o_orderpriority"},
                                                         tiebreak=["o_orderkey"])
    plans["first_touch_naive"] = lambda: naive.first_touch_naive(orders, ["k"], ["o_orderdate", "o_orderkey"],
                                                                 "o_orderpriority", "f")
    # a hot instant: the NULL key's rows all share one timestamp (a bulk load), a single tie group
    instant = orders.withColumn("o_orderdate", F.when(F.col("k").isNull(), F.lit("2000-01-01").cast("timestamp_ntz"))
                                .otherwise(F.col("o_orderdate")))
    plans["hot_instant_rewritten"] = lambda: sessionize(instant, "k", "o_orderdate", (15,), tiebreak=["o_orderkey"],
                                                        tiebreak_unique=True)
    plans["hot_instant_naive"] = lambda: naive.sessions_naive(instant, "k", "o_orderdate", (15,),
                                                              tiebreak=["o_orderkey"])
    for name, make in plans.items():
        spark.sparkContext.setJobGroup(name, name)
        make().write.format("noop").mode("overwrite").save()
    spark.stop()
    out = {"rows": n, "hot_key_rows": hot}
    out.update({f"max_task_shuffle_records_{k}": max_task_records(log_dir, k) for k in plans})
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line:
{"metric": "total_wall_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Each query is executed to completion with the no-op sink (all rows
computed, none collected).  Set BENCH_EVENT_LOG=<scratch folder> to keep
Spark's event log (stage and task times) for analysis.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["channel_revenue", "channel_revenue_web_refunds", "dedup_sales", "dq_split_totals",
            "refund_settlement", "merge_customers", "fact_key_lookup", "load_range_run"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from martlake.session import build_session
    from martlake.plans.catalog import QUERIES

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task timings without the UI: a scratch folder
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 4 * cpus), app_name="martlake-bench",
                          extra=extra)
    # JVM/JIT warm-up: one untimed pass of the same queries on the smallest tables
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_wall_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_finance", "fact_business_dev", "fact_project", "hr_utilization", "hr_deliverable_bridge",
    "scd2_client_two_runs", "merge_upsert_fact", "cutoff_last_update", "dim_deliverable",
    "activity_spine", "consultant_revenue_month", "check_range",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from practica.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="practica-bench")
    from practica.plans.queries import spark_queries
    qs = spark_queries()

    # warm the JVM (class loading, JIT, codegen caches) by running every timed
    # query once on the smallest data set; the timed runs are then warm
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        qs["dim_business_unit"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

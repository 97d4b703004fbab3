"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional), BENCH_REPEAT (default 2). Each query
is executed in full with the ``noop`` sink (every row produced, nothing
collected to the driver); the reported time is the best of the repeats.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "close_month_all",        # flagship: month close, all 43 columns
    "run_day_mid_all",        # ordinary daily run
    "backfill_two_months",    # two month closes in one job
    "backfill_all_days",      # every day of the data range in one job
    "metric_series_all",      # all 37 metrics, whole history
    "acceptor_cube",          # full 16-grouping-set cube with MTD users
    "hourly_cube",            # hourly cubes with MTD users
    "mtd_with_ties",          # row-grain month-to-date with tied timestamps
    "slice_rewrite_twice",    # write path: two idempotent slice rewrites
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from pacecast.plans.queries import registry
    from pacecast.session import build_session

    spark = build_session(master=f"local[{cpus}]",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus)),
                          app_name="pacecast-bench", driver_memory="16g")
    queries = registry()
    # warm-up (JVM class loading and JIT of the generated code) on the smallest
    # scale factor: the same code on other data, so timings below are steady-state
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        queries["close_month_all"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    timings = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):  # fresh DataFrames each time: nothing is reused between runs
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        timings[name] = round(best, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "stat": f"min of {repeat} runs per query",
    }))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENTLOG_DIR (optional: write a Spark event log there for
tools/eventlog_summary.py).
Each query runs to completion through the no-op sink (full execution, no
collect) twice: the first (cold) and second (warm) times are both printed;
``value`` is the warm total.  Caches are cleared between runs, so the warm
run recomputes everything (checkpoints included); only JIT/codegen is warm.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "a1_trip_frequency": "A1 trip frequency",
    "n10_path_frequency": "N10 path frequency",
    "a9_coverage_count": "A9 coverage count",
    "r6_route_recommendation": "R6 full pipeline",
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from routecov.plans.queries import QUERIES
    from routecov.session import get_session

    event_dir = os.environ.get("BENCH_EVENTLOG_DIR")  # optional, for tools/eventlog_summary.py
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir} if event_dir else None
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), extra_conf=extra)
    run(QUERIES["a1_trip_frequency"](spark, sf_dir))  # warm-up (JIT, file listing)
    spark.catalog.clearCache()

    cold, times = {}, {}
    for name in HEADLINE:
        for label, target in (("cold", cold), ("warm", times)):  # warm run is reported
            spark.sparkContext.setJobDescription(f"{name}:{label}")
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            target[name] = round(time.perf_counter() - t0, 3)
            spark.catalog.clearCache()
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold_queries": cold,
                      "cold_total": round(sum(cold.values()), 3), "sf": m.group(1) if m else sf_dir,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

All queries run once to warm up, then ``BENCH_RUNS`` (default 3) rounds
over all of them; the median per query is reported.  A run executes the whole plan into Spark's
``noop`` sink, so nothing is collected to the driver.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "refine_commits",
    "insert_only_merge",
    "incremental_refine",
    "consolidate_globs",
    "registry_upsert",
    "live_files",
    "live_files_incremental",
    "live_file_metrics",
    "resolve_locations",
    "land_batches",
    "live_file_intervals",
]


def main() -> None:
    from commitlens.plans.queries import QUERIES
    from commitlens.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    # one warm-up pass over all queries (JIT, fixture table), then the
    # timed runs round-robin so no query profits from its position
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    samples: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples[name].append(time.perf_counter() - t0)
    times = {n: round(statistics.median(v), 3) for n, v in samples.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

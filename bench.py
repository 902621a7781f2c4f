"""Benchmark: headline queries, warm, median of 3 runs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each run executes the full plan through the ``noop``
sink (no collect to the driver).  The one-time landing of the derived
reference-shaped tables is timed separately, cold.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "incremental_follows",                     # M2
    "follows_of_follows",                      # M10 (flagship)
    "popularity_ranked_follows_of_follows",    # M12
    "jetstream_events",                        # M11
    "incremental_followers",                   # M1
    "dim_profiles",                            # M6
    "followers_of_followers",                  # M7
    "followers_of_follows",                    # M8
    "follows_of_followers",                    # M9
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from hopgraph.session import build_session
    from hopgraph.sources import testdata as TD
    from hopgraph.queries import REGISTRY, Inputs

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g"})
    landing = {}
    t = time.perf_counter()
    TD.landed_edges_path(spark, sf_dir)
    landing["land_edges"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    TD.landed_jetstream_path(spark, sf_dir)
    landing["land_jetstream"] = round(time.perf_counter() - t, 3)

    t = time.perf_counter()
    for table in ("followers", "follows"):         # M1 / M2 as the stored tables that the views read
        Inputs(spark, sf_dir).stored(table)
    landing["store_m1_m2"] = round(time.perf_counter() - t, 3)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:        # warm-up: JIT, file listing caches
        run(name)
    queries = {}
    for name in HEADLINE:
        queries[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_warm_median_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "landing_cold": landing,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

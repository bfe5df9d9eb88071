"""Headline timings: one JSON line on standard output.

Each query runs once to warm up and then RUNS times (once if it takes over
LONG seconds); the median counts. A run builds the plan, executes it and writes
every row to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pageflow.plans.catalog import QUERIES
from pageflow.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LONG = 8.0

HEADLINE = (
    "edge_upsert",
    "trending_topics",
    "word_count",
    "search_index",
    "search_select",
    "search_ranked",
    "search_response",
    "search_stored",
    "monthly_traffic",
    "stream_edge_upsert",
    "trending_windowed",
    "volume_edge_upsert",
    "volume_search_index",
    "volume_search_response",
)


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of_runs(spark, name: str) -> float:
    run(spark, name)
    taken = [run(spark, name)]
    while taken[0] < LONG and len(taken) < RUNS:
        taken.append(run(spark, name))
    return round(statistics.median(taken), 3)


def main() -> None:
    shuffle = int(CPUS) if CPUS.isdigit() else 8
    spark = local_session("bench", CPUS, shuffle)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = median_of_runs(spark, name)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

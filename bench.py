"""Time the registered queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query, the
median counts), BENCH_QUERIES (comma-separated names, default all). Each query is built and run
once as warm-up; a timed run builds its plan anew and computes every row and column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from threadloom.plans.queries import QUERIES  # noqa: E402
from threadloom.session import build_session  # noqa: E402


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, sf_dir, name)
        times[name] = round(
            statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 4)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

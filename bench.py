"""Benchmark: run every registered pipeline query on $BENCH_SF_DIR.

Each query is built and fully executed (``noop`` sink: every row is
produced, nothing is collected to the driver).  One warm-up run, then
the median of $BENCH_REPEATS timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldlens.registry import QUERIES  # noqa: E402
from fieldlens.session import get_session  # noqa: E402


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_session(f"local[{cpus}]", app="fieldlens-bench", shuffle_partitions=partitions,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               "spark.ui.showConsoleProgress": "false"})
    timings: dict[str, float] = {}
    for name, (fn, _) in QUERIES.items():
        if only and not any(p in name for p in only):
            continue
        run_once(spark, fn, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 4)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_median_query_seconds", "value": round(sum(timings.values()), 4),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()

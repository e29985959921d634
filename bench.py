"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each query runs once to warm up, then BENCH_RUNS
times; the median wall time is reported. Queries are fully executed into
Spark's ``noop`` sink (no driver collection).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dossier.plans.catalog import QUERIES  # noqa: E402
from dossier.session import get_session  # noqa: E402

HEADLINE = ["top_matches", "keyword_counts", "keyword_counts_many", "keyword_hits_many", "fuzzy_hits", "sections",
            "candidate_summary", "append_applications"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="dossier-bench", shuffle_partitions=cpus,
                        extra={"spark.ui.showConsoleProgress": "false",
                               "spark.driver.memory": "16g",
                               "spark.dossier.scanTasks": str(cpus)})  # the test files are one row group each
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

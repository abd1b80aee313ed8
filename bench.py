"""Headline-query benchmark: prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs per query, default 3; one warm-up run
precedes them).  Each run executes the whole plan into Spark's ``noop`` sink,
so nothing is collected to the driver; the median run time is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starload.plans import registry  # noqa: E402
from starload.session import build_session  # noqa: E402

HEADLINE = [
    "sales_report",
    "stage_report",
    "resolve_facts",
    "upsert_type1",
    "replace_range",
    "bulk_load",
    "bulk_load_one_file",
    "assign_keys",
    "check_unique",
    "ingest_chunks",
    "date_dimension",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        app="starload-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(cpus * 2, 8),
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    queries = {name: registry.QUERIES[name] for name in HEADLINE if name in registry.QUERIES}
    timings: dict[str, float] = {}
    for name, build in queries.items():
        samples = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            if attempt:
                samples.append(elapsed)
        timings[name] = round(statistics.median(samples), 3)
    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_median_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf_match.group(1)) if sf_match else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed with the ``noop`` sink (every row computed, nothing
collected to the driver). One untimed warm-up query first (JVM start, codegen caches).
Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlink.plans.queries import QUERIES  # noqa: E402
from cohortlink.session import local_session  # noqa: E402

HEADLINE = (
    "counts_by_grade", "counts_grouping_sets", "counts_total_by_test", "event_extract", "wide_to_long",
    "settings_join_flags", "flag_summary", "missingness_by_group", "link_best", "link_legacy",
    "intake_routing", "log_upsert", "insert_if_absent",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, memory="8g", app="cohortlink-bench")
    QUERIES["reject_antijoin"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

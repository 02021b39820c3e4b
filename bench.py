"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs
after one warm-up; the median counts), BENCH_QUERIES (comma-separated names instead of the default).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.session import remove_scratch, session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = (
    "clean_text", "parse_locale_float", "parse_dates", "lookup_multi", "revenue_by_segment", "conform_orders",
    "party_golden", "party_crosswalk", "party_roles", "remap_orders", "dq_checks", "dq_unique", "dq_fk",
    "delete_propagation", "upsert_touch", "insert_if_absent", "next_ids",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # the tables are single files of a few MB: let several cores share one
            "spark.sql.files.maxPartitionBytes": "4m",
            "spark.sql.files.openCostInBytes": "1m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of cores. Each query runs
once to warm up, then its time is the median of BENCH_RUNS (2) runs. A run computes every row and
column and throws them away. Grids are landed as files during the warm-up, as an ingest job would.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleswright.session import local_session  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "clean_amount",
    "clean_quantity",
    "clean_date",
    "normalize_ledger",
    "load_metadata",
    "qc_issues",
    "qc_samples",
    "category_discrepancies",
    "exclusion_report",
    "reconcile_counts",
    "file_totals",
    "detect_header_alias",
    "profile_files_credit",
    "convert_template",
    "customer_values",
    "sku_changes",
    "nest_transactions",
    "export_request_text",
    "tabulate_records",
    "program_report_two",
    "qualify_yoy",
    "frame_totals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    for name in wanted:
        measured = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run > 0:
                measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()

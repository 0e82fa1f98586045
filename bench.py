"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default all). Every
query runs whole, writes included, into a sink that drops the rows: once to warm up, then
BENCH_RUNS times (default 2), of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from quayside.catalog import QUERIES
from quayside.session import build_session

HEADLINE = (
    "scan_csv",
    "scan_recursive",
    "sink_csv",
    "sink_partitioned",
    "count_csv_records",
    "count_parquet_rows",
    "count_landing",
    "reconcile_counts",
    "filter_blank_lines",
    "update_processed",
    "tokenize_hash",
    "tokenize_reversible",
    "tokenize_surrogate_skewed",
    "tokenize_template",
    "dq_suite",
    "dq_unexpected_rows",
    "expect_column_median_to_be_between",
    "profile_columns_orders",
    "profile_table",
    "profile_topk",
    "profile_quantiles",
    "profile_histogram",
    "audit_files_to_files",
    "union_audit",
    "audit_summary",
    "latest_audit",
    "stream_ingest",
    "landing_run",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    conf = {
        "spark__sql__shuffle__partitions": cpus,
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__driver__memory": os.environ.get("BENCH_MEMORY", "4g"),
        "spark__checkpoint__dir": os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="run-"),
    }
    spark = build_session(f"local[{cpus}]", "quayside-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from probity.session import builder  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "dq_completeness",
    "dq_validity",
    "dq_consistency",
    "dq_timeliness",
    "dq_uniqueness",
    "dq_uniqueness_composite",
    "dq_referential",
    "dq_orphan_rows",
    "dq_duplicate_rows",
    "dq_metrics_all",
    "dq_overall",
    "clean_filings",
    "clean_summary",
    "first_per_key",
    "missing_before_after",
    "quick_stats",
    "issue_log",
    "kpi_row",
    "lineage_flow",
    "inject_defects",
    "audit_expand",
    "nat_ship_before_order",
    "nat_duplicate_text",
    "nat_duplicate_text_rows",
    "nat_foreign_keys",
    "csv_roundtrip",
    "summary_roundtrip",
]


def main() -> None:
    spark = (
        builder("probity-bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="probity-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        for _ in range(2):  # warm-up: class loading and code generation
            run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "lineitem_rows": lines,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

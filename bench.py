"""Time the headline queries; print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores),
BENCH_RUNS (timed runs per query, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loadledger import workload  # noqa: E402

# Lazy queries, run to a sink that discards the rows.
LAZY = (
    "latest_per_key",
    "revision_stats",
    "history_append",
    "merge_latest",
    "pivot_hourly",
    "merge_hourly",
    "daily_kpi",
    "merge_daily",
    "trailing_kpi",
    "weekend_share",
    "dq_row_rules",
    "dq_duplicates",
    "dq_coverage",
    "coverage_gaps",
    "day_fingerprint",
    "snapshot_diff",
    "reconcile",
    "normalize_period",
)
# Queries that write tables or files while they run.
WRITING = ("land_days", "incremental_refresh", "stream_bronze", "layers_from_landing")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loadledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loadledger-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in LAZY:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    for name in WRITING:
        once(name)
        seconds[name] = round(once(name), 3)

    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

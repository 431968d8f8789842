"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. Each query runs once to
warm up, then BENCH_RUNS times into a sink that takes every row and drops it; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tidemark.session import RUNTIME_CONF
from workload.queries import REGISTRY

HEADLINE = [
    "agg_monthly_avg",
    "agg_monthly_avg_sum_count",
    "join_inner",
    "cogroup_first_left",
    "profile_table",
    "ffill_all",
    "ffill_by_key",
    "ffill_after_try_cast",
    "row_index_zero_based",
    "row_index_one_based",
    "sql_cte_filter",
    "flow_drop_then_fill_clean",
    "flow_drop_then_fill_agg",
    "flow_fill_all_clean",
    "flow_fill_all_agg",
    "flow_fill_selected_agg",
    "flow_cogroup_agg",
    "flow_validated_clean",
    "flow_validated_agg",
    "flow_sql_drop_nulls_agg",
    "flow_zero_repair_agg",
    "flow_published",
    "ffill_all_blocks",
    "ffill_hashed_key_blocks",
    "row_index_busy_day_blocks",
    "flow_drop_then_fill_blocks_clean",
    "flow_fill_all_blocks_clean",
    "flow_fill_selected_blocks_agg",
    "flow_cogroup_blocks_agg",
    "flow_validated_blocks_clean",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

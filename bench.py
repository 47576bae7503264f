"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local threads; BENCH_QUERIES:
names to run instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statement_lake.plans.queries import queries  # noqa: E402
from statement_lake.session import apply_options  # noqa: E402

HEADLINE = (
    "content_hash",
    "parse_timestamps",
    "parse_numbers",
    "ingest_trades",
    "normalize_bars",
    "batch_summary",
    "upsert_by_hash",
    "upsert_replace_dates",
    "upsert_by_key",
    "upsert_bars",
    "bulk_last_file_wins",
    "symbol_first_seen",
    "symbol_map_full",
    "registry_fold",
    "symbol_dictionary",
    "trades_history",
    "positions_latest",
    "account_nav_history",
    "symbol_codes",
    "obfuscate_trades",
    "job_state",
    "manifest_latest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        apply_options(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the executors
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

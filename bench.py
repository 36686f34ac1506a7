"""Headline timings at one scale; prints one JSON line.

BENCH_SF_DIR chooses the tables (default /root/testdata/sf0.1) and BENCH_CPUS the task slots
(default: all). Every query runs once to warm up and is then timed BENCH_RUNS times; the
median counts. Results are consumed by Spark's noop sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import all_queries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "scan_full",
    "incremental_by_date",
    "normalized_texts",
    "raw_payload_orders",
    "record_key_hash",
    "upsert_last_write_wins",
    "upsert_hot_key",
    "upsert_idempotent",
    "upsert_onto_snapshot",
    "batch_ledger_ties",
    "scan_keyset_batches",
    "scan_keyset_ties",
    "messages_lifecycle",
    "resolve_requests",
    "validate_source_requests",
    "execution_ledger",
    "catalog_columns_postgres",
    "catalog_columns_sqlserver",
    "catalog_roll_up",
    "sync_full_end_to_end",
    "sync_incremental_end_to_end",
    "sync_last_write_wins",
    "sync_repeated",
    "stream_ingest",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    queries = all_queries()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        query = queries[name][0]
        taken = []
        for attempt in range(RUNS + 1):
            begin = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            if attempt:
                taken.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(taken), 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_SHARED the folder for
working tables. Every query runs twice and the second run counts. What a lake's job keeps is written
as Parquet, like the published steps; other results go to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from ledgermill import catalog  # noqa: E402
from ledgermill.operators import clean, dedup, tables, upsert  # noqa: E402
from ledgermill.plans import lookups  # noqa: E402
from ledgermill.session import build_session  # noqa: E402
from ledgermill.workspace import drop_workspace, new_path  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
CATALOG = [
    "gold_customers", "gold_transactions", "gold_transactions_union_intent",
    "risk_signals_union_intent", "velocity_alerts", "large_tx_flags", "large_tx_flags_intent",
    "dq_report", "velocity_window", "quarantine_reasons_intent", "rpt_customer_summary",
    "rpt_daily_summary", "rfm_scores_orders", "dedup_latest_lineitem", "stream_hourly",
]

KEPT = {"gold_customers", "gold_transactions", "gold_transactions_union_intent",
        "risk_signals_union_intent"}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def keep(df: DataFrame) -> None:
    df.write.parquet(new_path(df.sparkSession, "bench"))


def second_run(job: Callable[[], None]) -> float:
    job()
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS),
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
               "spark.driver.memory": "16g"},
        shared_folder=os.environ.get("BENCH_SHARED"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = catalog.tables_of(spark, FOLDER)
    queries = catalog.queries()

    bronze_path = new_path(spark, "bronze")
    t.bronze.write.parquet(bronze_path)
    bronze = spark.read.parquet(bronze_path)
    messages = bronze.count()
    t.silver, t.customers, t.accounts  # written before the clock starts

    def merge() -> None:
        path = new_path(spark, "bench-upsert")
        tables.append(t.silver, path, "event_date")
        upsert.upsert_transactions(spark, path, dedup.dedup_latest(clean.clean_transactions(bronze)))

    jobs: dict[str, Callable[[], None]] = {
        "bronze_ingest": lambda: run(t.landed(t.bronze_stream(), "ingestion_date")),
        "silver_clean": lambda: keep(clean.clean_transactions(bronze)),
        "silver_dedup": lambda: keep(dedup.dedup_latest(clean.clean_transactions(bronze))),
        "silver_upsert": merge,
        "spend_naive": lambda: run(lookups.spend_naive(
            t.silver, t.customers, t.accounts, lookups.TYPE_KEYS)),
        "spend_preaggregated": lambda: run(lookups.spend_by_account_type(
            t.silver, t.customers, t.accounts)),
    }
    for name in CATALOG:
        sink = keep if name in KEPT else run
        jobs[name] = lambda name=name, sink=sink: sink(queries[name](spark, FOLDER))
    seconds = {name: round(second_run(job), 3) for name, job in jobs.items()}
    drop_workspace(spark)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")),
        "messages": messages,
        "messages_per_second": {n: round(messages / s) for n, s in seconds.items() if s},
    }))


if __name__ == "__main__":
    main()

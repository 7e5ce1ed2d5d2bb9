"""One day of the lake, from bronze to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgermill import schemas
from ledgermill.functions import times
from ledgermill.operators import clean, dedup, quality, tables, upsert
from ledgermill.plans import customers as customer_plans
from ledgermill.plans import risk, rollups, transactions
from ledgermill.sources.scans import scan_day, scan_lookback
from ledgermill.workspace import new_path, scratch, stage


@dataclass(frozen=True)
class Lake:
    """Where the tables of one lake are."""

    base: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    @property
    def bronze(self) -> str:
        return self.path("bronze", "transactions")

    @property
    def silver(self) -> str:
        return self.path("silver", "transactions")

    @property
    def quarantine(self) -> str:
        return self.path("silver", "transactions_quarantine")

    @property
    def customers(self) -> str:
        return self.path("silver", "customers")

    @property
    def dq_metrics(self) -> str:
        return self.path("silver", "dq_metrics")

    def states(self, table: str) -> str:
        return self.path("states", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)


def refine_day(spark: SparkSession, lake: Lake, day: str | dt.date) -> dict[str, int]:
    """Bronze of one arrival day into silver and quarantine; repeating it changes nothing.

    The day is parsed once: valid and rejected rows go to one staged table, split by partition.
    """
    bronze = spark.read.schema(schemas.BRONZE).parquet(lake.bronze)
    arrived = scan_day(bronze, "ingestion_date", day)
    parsed_path = new_path(spark, "parsed")
    routed = arrived.transform(clean.parse_payload, keep_raw=True).transform(clean.route)
    routed.write.partitionBy("is_valid").parquet(parsed_path)
    parsed = spark.read.schema(routed.schema).parquet(parsed_path)
    rejected = parsed.filter(~F.col("is_valid")).drop("is_valid")
    tables.replace_partition(
        rejected.withColumn("quarantined_at", F.current_timestamp()), lake.quarantine,
        "ingestion_date", [day],
    )
    accepted = parsed.filter("is_valid").drop("is_valid", "quarantine_reason", "raw_payload")
    batch = dedup.dedup_latest(clean.correct_values(accepted))
    return upsert.upsert_transactions(spark, lake.silver, batch)


def _customers(spark: SparkSession, lake: Lake) -> DataFrame | None:
    if tables.table_exists(spark, lake.customers):
        return spark.read.schema(schemas.CUSTOMERS).parquet(lake.customers)
    return None


def _silver(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(lake.silver)


def check_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, as_of: str | None = None,
    thresholds: Mapping[str, float] | None = None,
) -> bool:
    """Write the day's quality metrics and return the gate's verdict.

    ``as_of`` is the moment of checking: by default now, or the end of a day that is over.
    """
    silver = _silver(spark, lake)
    today = scan_day(silver, "event_date", day)
    end = F.date_add(times.day(day), 1).cast("timestamp")
    moment = F.least(F.current_timestamp(), end) if as_of is None else as_of
    recent = scan_lookback(silver, day, quality.HISTORY_DAYS)
    volume = scan_day(quality.dq_volume(recent, last=day), "process_date", day)
    report = quality.dq_report(
        today, _customers(spark, lake), moment, thresholds=thresholds, volume=volume)
    tables.replace_partition(report, lake.dq_metrics, "process_date", [day])
    return gate_open(spark, lake, day)


def gate_open(spark: SparkSession, lake: Lake, day: str | dt.date) -> bool:
    """The verdict on a day from its stored metrics; a day without any passes."""
    if not tables.table_exists(spark, lake.dq_metrics):
        return True
    metrics = spark.read.schema(schemas.DQ_METRICS).parquet(lake.dq_metrics)
    return quality.dq_gate(scan_day(metrics, "process_date", day)).first()["gate_passed"]


def bronze_is_fresh(spark: SparkSession, lake: Lake, as_of: str | None = None) -> bool:
    bronze = spark.read.schema(schemas.BRONZE).parquet(lake.bronze)
    return quality.bronze_freshness(bronze, as_of).first()["is_fresh"]


def customers_from_states(
    spark: SparkSession, lake: Lake, customers: DataFrame, day: str | dt.date,
    buckets: int | None = None,
) -> DataFrame:
    """The customer snapshot from daily states, brought up to date with silver first.

    Bucketed states have folders of their own, one for each number of buckets.
    """
    suffix = f"_in_{buckets}" if buckets else ""
    days, accounts = (lake.states(f"{n}{suffix}") for n in ("customer_days", "customer_day_accounts"))
    rollups.refresh_customers(_silver(spark, lake), days, accounts, buckets)
    return rollups.gold_customers_from_days(spark, days, accounts, customers, day, buckets)


def gold_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, from_states: bool = False,
    buckets: int | None = None,
) -> None:
    """Replace the day's snapshots of all gold tables; one that comes out empty goes.

    ``from_states`` takes the customers from daily states, of which a day changes few, instead of
    91 days of the ledger; quantiles of customers with over 200 transactions are then within 1.7 %
    of their rank. With ``buckets`` the states are kept in so many buckets of customers.
    """
    silver = _silver(spark, lake)
    customers = spark.read.schema(schemas.CUSTOMERS).parquet(lake.customers)
    of_customers = (customers_from_states(spark, lake, customers, day, buckets) if from_states
                    else customer_plans.gold_customers(silver, customers, day))
    snapshots = {
        "customer_analytics": (
            of_customers, ["customer_id", "segment"]),
        "transaction_analytics": (
            transactions.gold_transactions_union(silver, day), ["event_date", "transaction_type"]),
        "risk_metrics": (risk.gold_risk(silver, day), ["currency"]),
        "risk_signals": (
            risk.risk_signals_of_day(silver, customers, day), ["risk_signal"]),
    }
    for name, (snapshot, order) in snapshots.items():
        ordered = tables.clustered(
            stage(snapshot.withColumn("processed_at", F.current_timestamp()), name), order
        )
        tables.replace_partition(ordered, lake.gold(name), "process_date", [day])


def run_day(
    spark: SparkSession, lake: Lake, day: str | dt.date, as_of: str | None = None,
    thresholds: Mapping[str, float] | None = None, from_states: bool = False,
    buckets: int | None = None,
) -> dict:
    """Silver, quality, and gold unless the gate is shut; leaves no working tables behind."""
    with scratch(spark):
        counts = refine_day(spark, lake, day)
        passed = check_day(spark, lake, day, as_of, thresholds)
        if passed:
            gold_day(spark, lake, day, from_states, buckets)
    return {**counts, "gate_passed": passed}

"""Transaction analytics at four granularities.

Alone, a granularity is its own scan: parquet hands it only the few narrow columns it groups by,
and the partial aggregation shrinks a task's rows to its groups before the shuffle. Together they
roll up from one scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgermill.functions.measures import (
    beside, mean_from, quantile_bounds, quantiles_by, quantiles_within, rows, total,
)
from ledgermill.functions.times import day
from ledgermill.operators.clean import tag_rows, unify_versions
from ledgermill.sources.scans import TRANSACTION_LOOKBACK, has_payment, scan_lookback
from ledgermill.workspace import stage

QUANTILES = {"p50_amount": 0.50, "p95_amount": 0.95, "p99_amount": 0.99}


def _volume() -> list[Column]:
    return [rows().alias("tx_count"), total("amount").alias("total_volume")]


def quantiles(df: DataFrame, keys: list[str], accuracy: int = 10_000) -> DataFrame:
    """Exact amount quantiles per group; the bounds they are looked for in are staged."""
    bounds = stage(quantile_bounds(df, keys, QUANTILES, accuracy), "quantile-bounds")
    return quantiles_within(df, bounds, keys, QUANTILES)


def daily_by_type(transactions: DataFrame) -> DataFrame:
    status = F.col("status")
    measures = [
        *_volume(),
        F.avg("amount").alias("avg_amount"),
        F.count_if(status == "completed").alias("completed_count"),
        F.count_if(status == "failed").alias("failed_count"),
        F.count_if("is_late_arrival").alias("late_arrival_count"),
    ]
    keys = ["event_date", "transaction_type", "currency"]
    return (
        quantiles_by(transactions, keys, measures, QUANTILES)
        .withColumn("success_rate", F.col("completed_count") / F.col("tx_count"))
        .withColumn("granularity", F.lit("daily_by_type"))
    )


def daily_by_merchant(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("event_date", "merchant_category").agg(
        *_volume(),
        F.avg("amount").alias("avg_amount"),
        F.count_distinct("merchant").alias("unique_merchants"),
    ).withColumn("granularity", F.lit("daily_by_merchant"))


def hourly_volume(transactions: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "timestamp").alias("hour")
    return (
        transactions.groupBy(hour, "transaction_type").agg(*_volume())
        .withColumn("event_date", F.to_date("hour"))
        .withColumn("granularity", F.lit("hourly"))
    )


def daily_by_payment(transactions: DataFrame) -> DataFrame:
    return has_payment(transactions).groupBy("event_date", "payment_method").agg(
        *_volume()
    ).withColumn("granularity", F.lit("daily_by_payment"))


def gold_transactions(silver: DataFrame, process_date: str | dt.date) -> DataFrame:
    """The daily-by-type snapshot of one day."""
    recent = scan_lookback(silver, process_date, TRANSACTION_LOOKBACK)
    return tag_rows(daily_by_type(recent), process_date=day(process_date))


def volume_base(transactions: DataFrame) -> DataFrame:
    """Sums at the finest grain that the four granularities share; they roll up from it."""
    status = F.col("status")
    return transactions.groupBy(
        "event_date", F.date_trunc("hour", "timestamp").alias("hour"), "transaction_type",
        "currency", "merchant_category", "payment_method",
    ).agg(
        *_volume(),
        F.count_if(status == "completed").alias("completed_count"),
        F.count_if(status == "failed").alias("failed_count"),
        F.count_if("is_late_arrival").alias("late_arrival_count"),
    )


def _rolled(base: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    return base.groupBy(*keys).agg(
        total("total_volume").alias("total_volume"),
        *[F.sum(c).alias(c) for c in ["tx_count", *counts]])


def granularities(recent: DataFrame) -> DataFrame:
    """All four granularities in one frame; columns a granularity lacks are NULL.

    One wide scan is summed and staged; the other scans read what sums cannot give, quantiles and
    distinct merchants, and only the columns for these.
    """
    base = stage(volume_base(recent), "volume-base")
    mean = mean_from(F.col("total_volume"), F.col("tx_count"))
    type_keys = ["event_date", "transaction_type", "currency"]
    merchant_keys = ["event_date", "merchant_category"]
    by_type = beside(
        _rolled(base, type_keys, ["completed_count", "failed_count", "late_arrival_count"]),
        quantiles(recent, type_keys), type_keys,
    ).withColumns({
        "avg_amount": mean,
        "success_rate": F.col("completed_count") / F.col("tx_count"),
        "granularity": F.lit("daily_by_type"),
    })
    merchants = recent.groupBy(*merchant_keys).agg(
        F.count_distinct("merchant").alias("unique_merchants"))
    by_merchant = beside(_rolled(base, merchant_keys, []), merchants, merchant_keys).withColumns(
        {"avg_amount": mean, "granularity": F.lit("daily_by_merchant")})
    hourly = _rolled(base, ["hour", "transaction_type"], []).withColumns(
        {"event_date": F.to_date("hour"), "granularity": F.lit("hourly")})
    by_payment = _rolled(has_payment(base), ["event_date", "payment_method"], []).withColumn(
        "granularity", F.lit("daily_by_payment"))
    return unify_versions(by_type, by_merchant, hourly, by_payment)


def gold_transactions_union(silver: DataFrame, process_date: str | dt.date) -> DataFrame:
    """All four granularities in one snapshot."""
    recent = scan_lookback(silver, process_date, TRANSACTION_LOOKBACK)
    return tag_rows(granularities(recent), process_date=day(process_date))


def gold_transactions_snapshots(
    silver: DataFrame, process_dates: Sequence[str | dt.date]
) -> dict[str | dt.date, DataFrame]:
    """``gold_transactions_union`` of several days, the ledger aggregated once for all of them.

    Every row is of one event day (that of the timestamps), so snapshots that share a day share
    its rows: they are staged, and a snapshot is a selection of days.
    """
    wanted = reduce(Column.__or__, [
        F.col("event_date").between(F.date_sub(day(d), TRANSACTION_LOOKBACK), day(d))
        for d in process_dates])
    days = stage(granularities(silver.filter(wanted)), "gold-days")
    return {d: tag_rows(scan_lookback(days, d, TRANSACTION_LOOKBACK), process_date=day(d))
            for d in process_dates}


def currency_volume(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("event_date", "currency").agg(*_volume())

"""Risk signals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ledgermill.functions.measures import rows, total
from ledgermill.functions.scoring import outsized_level
from ledgermill.functions.times import day, epoch_second
from ledgermill.operators.clean import tag_rows, unify_versions
from ledgermill.operators.trailing import trailing_count_per_second, trailing_daily_mean
from ledgermill.plans.transactions import currency_volume
from ledgermill.sources.scans import open_status, scan_day, scan_lookback
from ledgermill.workspace import stage

# Limits of the signals.
VELOCITY_SECONDS = 600
VELOCITY_LIMIT = 5
OUTSIZED_FACTOR = 3
FAILURE_LIMIT = 0.20
FAILURE_LEAST = 5
MEAN_DAYS = 30

SIGNAL_COLUMNS = {
    "account_id": "string", "customer_id": "string", "risk_signal": "string",
    "risk_level": "string", "transaction_id": "string", "flagged_amount": "decimal(28,2)",
    "latest_flagged_at": "timestamp",
}


def velocity_alerts(
    transactions: DataFrame, seconds: int = VELOCITY_SECONDS, limit: int = VELOCITY_LIMIT,
    on: str | dt.date | None = None,
) -> DataFrame:
    """Accounts with more than ``limit`` transactions in some trailing ``seconds``.

    ``on`` reports the transactions of one day only; those before it still count in the windows
    that begin there. The seconds above the limit are few, so they are staged: their size on disk
    then tells Spark whether to broadcast them to the ledger scan, which saves the ledger a
    shuffle, or to sort and merge.
    """
    timed = transactions.select(
        "account_id", "customer_id", "amount", "timestamp",
        epoch_second(F.col("timestamp")).alias("second"),
    )
    counts = trailing_count_per_second(timed, "account_id", "second", seconds)
    flagged = stage(counts.filter(F.col("trailing_count") > limit), "velocity")
    reported = timed if on is None else timed.filter(F.col("timestamp").cast("date") == day(on))
    return tag_rows(
        reported.join(flagged, ["account_id", "second"])
        .groupBy("account_id", "customer_id")
        .agg(
            F.max("trailing_count").alias("max_tx_in_window"),
            rows().alias("flagged_transactions"),
            total("amount").alias("flagged_amount"),
            F.max("timestamp").alias("latest_flagged_at"),
        ),
        risk_signal="velocity_alert", risk_level="HIGH",
    )


def _outsized(transactions: DataFrame, means: DataFrame, keys: list[str]) -> DataFrame:
    """Rows above the factor times their mean.

    The means are staged: a join with a finished table is split where a customer is hot, one with
    an aggregate on the same key is not. No hint, as they grow with the customers. Levels compare
    decimals, so an amount of exactly ten times the mean is not above it.
    """
    mean = F.col("customer_avg_amount")
    ratio = F.try_divide(F.col("amount"), mean)
    flagged = (
        transactions.join(stage(means, "means"), keys)
        .filter(F.col("amount") > mean * OUTSIZED_FACTOR)
        .select("account_id", "customer_id", "transaction_id", "amount", "customer_avg_amount",
                ratio.alias("amount_vs_avg_ratio"), "timestamp")
    )
    return tag_rows(
        flagged, risk_signal="large_transaction",
        risk_level=outsized_level(F.col("amount"), F.col("customer_avg_amount")),
    )


def large_tx_flags(transactions: DataFrame) -> DataFrame:
    """Amounts above three times the customer's mean over the frame."""
    means = transactions.groupBy("customer_id").agg(F.avg("amount").alias("customer_avg_amount"))
    return _outsized(transactions, means, ["customer_id"])


def large_tx_flags_trailing(transactions: DataFrame, days: int = MEAN_DAYS) -> DataFrame:
    """Amounts above three times the customer's mean over that day and the ``days`` before."""
    means = trailing_daily_mean(
        transactions, "customer_avg_amount", "customer_id", "amount", "event_date", days
    )
    return _outsized(transactions, means, ["customer_id", "event_date"])


def geo_anomalies(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Spending from a country other than the customer's; rows are summed before the join."""
    per_country = (
        transactions.filter(F.col("ip_country").isNotNull())
        .groupBy("customer_id", "ip_country")
        .agg(rows().alias("_n"), total("amount").alias("_amount"), F.max("timestamp").alias("_at"))
    )
    return tag_rows(
        per_country.join(customers.select("customer_id", "country"), "customer_id")
        .filter(F.col("ip_country") != F.col("country"))
        .groupBy("customer_id", "ip_country", "country")
        .agg(
            F.sum("_n").alias("anomalous_tx_count"),
            F.sum("_amount").cast("decimal(28,2)").alias("anomalous_amount"),
            F.max("_at").alias("latest_at"),
        ),
        risk_signal="geo_anomaly", risk_level="MEDIUM",
    )


def failure_rate_flags(transactions: DataFrame) -> DataFrame:
    counted = transactions.groupBy("account_id", "customer_id").agg(
        rows().alias("total_tx"),
        F.count_if(F.col("status") == "failed").alias("failed_tx"),
    ).withColumn("failure_rate", F.col("failed_tx") / F.col("total_tx"))
    return tag_rows(
        counted.filter((F.col("failure_rate") > FAILURE_LIMIT)
                       & (F.col("total_tx") >= FAILURE_LEAST)),
        risk_signal="high_failure_rate", risk_level="MEDIUM",
    )


def currency_exposure(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Open and settled volume by currency, segment and country; summed per customer first."""
    per_customer = (
        open_status(transactions).groupBy("customer_id", "currency")
        .agg(rows().alias("_n"), total("amount").alias("_amount"))
    )
    return tag_rows(
        per_customer.join(customers.select("customer_id", "segment", "country"), "customer_id")
        .groupBy("currency", "segment", "country")
        .agg(
            F.sum("_amount").cast("decimal(28,2)").alias("total_exposure"),
            F.sum("_n").alias("transaction_count"),
            rows().alias("customer_count"),  # one row per customer and currency here
        ),
        risk_signal="currency_exposure", risk_level="INFO",
    )


def _as_signal(df: DataFrame, **renamed: str) -> DataFrame:
    """The common signal row; columns a signal lacks are NULL."""
    origin = {c: renamed.get(c, c) for c in SIGNAL_COLUMNS}
    return df.select(*[
        (F.col(origin[c]) if origin[c] in df.columns else F.lit(None)).cast(kind).alias(c)
        for c, kind in SIGNAL_COLUMNS.items()
    ])


def _union(
    velocity: DataFrame, large: DataFrame, transactions: DataFrame, customers: DataFrame,
    process_date: str | dt.date | Column,
) -> DataFrame:
    signals = [
        _as_signal(velocity),
        _as_signal(large, flagged_amount="amount", latest_flagged_at="timestamp"),
        _as_signal(geo_anomalies(transactions, customers), flagged_amount="anomalous_amount",
                   latest_flagged_at="latest_at"),
        _as_signal(failure_rate_flags(transactions)),
        _as_signal(currency_exposure(transactions, customers), flagged_amount="total_exposure"),
    ]
    return tag_rows(unify_versions(*signals), process_date=day(process_date))


def risk_signals(
    transactions: DataFrame,
    customers: DataFrame,
    process_date: str | dt.date | Column,
    seconds: int = VELOCITY_SECONDS,
    limit: int = VELOCITY_LIMIT,
) -> DataFrame:
    """All five signals of a frame in one shape."""
    return _union(velocity_alerts(transactions, seconds, limit), large_tx_flags(transactions),
                  transactions, customers, process_date)


def risk_signals_of_day(
    silver: DataFrame,
    customers: DataFrame,
    process_date: str | dt.date,
    seconds: int = VELOCITY_SECONDS,
    limit: int = VELOCITY_LIMIT,
) -> DataFrame:
    """All five signals of one day: bursts that began before midnight count in full, and amounts
    are measured by the customer's mean over that day and the ``MEAN_DAYS`` before."""
    today = scan_day(silver, "event_date", process_date)
    start = day(process_date).cast("timestamp")
    near = scan_lookback(silver, process_date, -(-seconds // 86_400)).filter(
        F.col("timestamp") >= start - F.make_dt_interval(secs=F.lit(seconds)))
    month = scan_lookback(silver, process_date, MEAN_DAYS)
    means = month.groupBy("customer_id").agg(F.avg("amount").alias("customer_avg_amount"))
    return _union(
        velocity_alerts(near, seconds, limit, process_date),
        _outsized(today, means, ["customer_id"]), today, customers, process_date)


def gold_risk(silver: DataFrame, process_date: str | dt.date) -> DataFrame:
    """Volume by currency of one day, the table the risk job keeps."""
    today = scan_day(silver, "event_date", process_date)
    return tag_rows(currency_volume(today), process_date=day(process_date))

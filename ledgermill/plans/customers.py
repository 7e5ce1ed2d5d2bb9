"""Customer analytics: value, recency / frequency / monetary scores, activity tier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions.measures import distinct_days, quantiles_of_counts, rows, total
from ledgermill.functions.scoring import activity_tier
from ledgermill.functions.times import day
from ledgermill.operators.ntile import add_ntiles
from ledgermill.sources.scans import CUSTOMER_LOOKBACK, not_failed, scan_lookback
from ledgermill.workspace import stage

CUSTOMER_COLUMNS = ["customer_id", "name", "country", "segment", "preferred_currency", "age"]
SCORES = ["recency_score", "frequency_score", "monetary_score"]


def recent_activity(silver: DataFrame, process_date: str | dt.date) -> DataFrame:
    return not_failed(scan_lookback(silver, process_date, CUSTOMER_LOOKBACK))


def customer_core_agg(
    transactions: DataFrame, process_date: str | dt.date, lookback: int = CUSTOMER_LOOKBACK
) -> DataFrame:
    """One row per customer of the ``lookback`` days before ``process_date`` and that day.

    Rows outside that range don't count, whatever frame is given. Active days are a bit set, so the only distinct count left is that of accounts and Spark
    needs no row expansion; every other measure merges map-side. The quantile is exact, from a
    grouping of its own, which reads two columns and counts equal amounts of a customer before
    they meet; both sides come out partitioned by customer, so joining them shuffles nothing.
    """
    kind = F.col("transaction_type")
    transactions = scan_lookback(transactions, process_date, lookback)
    counts = transactions.groupBy("customer_id", "amount").agg(rows().alias("n"))
    spread = quantiles_of_counts(counts, ["customer_id"], {"p95_transaction_value": 0.95})
    values = transactions.groupBy("customer_id").agg(
        rows().alias("total_transactions"),
        total("amount").alias("total_spend"),
        F.avg("amount").alias("avg_transaction_value"),
        F.max("timestamp").alias("last_transaction_at"),
        F.min("timestamp").alias("first_transaction_at"),
        F.max("event_date").alias("last_event_date"),
        distinct_days("event_date", day(process_date), lookback + 1).alias("active_days"),
        F.count_distinct("account_id").alias("accounts_used"),
        total("amount", kind == "purchase").alias("total_purchases"),
        total("amount", kind == "transfer").alias("total_transfers"),
    )
    return values.join(spread, "customer_id")


def rfm_agg(transactions: DataFrame, process_date: str | dt.date) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.datediff(day(process_date), F.max("event_date")).alias("recency_days"),
        rows().alias("frequency"),
        total("amount").alias("monetary"),
    )


def rfm_from_core(core: DataFrame, process_date: str | dt.date) -> DataFrame:
    """The recency, frequency and monetary columns of an aggregate that has them already."""
    return core.withColumns({
        "recency_days": F.datediff(day(process_date), F.col("last_event_date")),
        "frequency": F.col("total_transactions"),
        "monetary": F.col("total_spend"),
    })


def rfm_scores(rfm: DataFrame, recent_is_best: bool = False) -> DataFrame:
    """Quintiles 1-5 of the three measures and their sum; ``rfm`` should be staged.

    The plain form ranks recency ascending like the other two; ``recent_is_best`` turns it
    round, so that 5 is best throughout.
    """
    recency = -F.col("recency_days") if recent_is_best else F.col("recency_days")
    orders = dict(zip(SCORES, [recency, F.col("frequency"), F.col("monetary")]))
    scored = add_ntiles(rfm, 5, orders, "customer_id")
    return scored.withColumn("rfm_score", F.col(SCORES[0]) + F.col(SCORES[1]) + F.col(SCORES[2]))


def with_tier(scored: DataFrame) -> DataFrame:
    return scored.withColumn("activity_tier", activity_tier(F.col("rfm_score")))


def with_customer(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer attributes, NULL for unknown customers.

    Both sides have one row per customer, so they are sort-merged: a dimension that is small as a
    file may be large in memory, and a broadcast would pass it through the driver.
    """
    dimension = customers.select(*CUSTOMER_COLUMNS).hint("merge")
    return per_customer.join(dimension, "customer_id", "left")


def gold_customers(
    silver: DataFrame, customers: DataFrame, process_date: str | dt.date
) -> DataFrame:
    """The customer snapshot of one day.

    The aggregate is staged: three rankings read it, and it is far smaller than the ledger.
    """
    core = stage(
        customer_core_agg(recent_activity(silver, process_date), process_date), "customer-core"
    )
    return snapshot(core, customers, process_date)


def snapshot(core: DataFrame, customers: DataFrame, process_date: str | dt.date) -> DataFrame:
    """Scores, tier and attributes beside the (staged) customer aggregate of a day."""
    scored = with_tier(rfm_scores(rfm_from_core(core, process_date)))
    return (
        with_customer(scored, customers)
        .drop("last_event_date", "frequency", "monetary")
        .withColumn("process_date", day(process_date))
    )

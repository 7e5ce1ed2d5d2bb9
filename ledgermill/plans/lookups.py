"""Joins with the customer and account dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions.measures import mean_from, rows, total
from ledgermill.sources.scans import TRANSACTION_LOOKBACK, scan_lookback
from ledgermill.workspace import stage


def orphans(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions whose customer the dimension does not know; a missing customer is unknown.

    Distinct ids meet the dimension, not rows. The unknown ones are staged, so that Spark knows
    their size and sends them to the ledger scan where they are few, which is the normal case.
    """
    ids = transactions.select("customer_id").distinct()
    unknown = stage(
        ids.join(customers.select("customer_id"), "customer_id", "left_anti"), "orphans"
    ).withColumnRenamed("customer_id", "_unknown")
    return transactions.join(
        unknown, F.col("customer_id").eqNullSafe(F.col("_unknown")), "left_semi")


SEGMENT_KEYS = ["customer_id", "segment", "country"]
TYPE_KEYS = [*SEGMENT_KEYS, "account_type"]


def spend_naive(
    transactions: DataFrame, customers: DataFrame, accounts: DataFrame,
    keys: list[str] = SEGMENT_KEYS,
) -> DataFrame:
    """The yardstick: every row joined with both whole dimensions, then grouped."""
    owned = accounts.drop("customer_id").withColumnRenamed("status", "account_status") \
        .withColumnRenamed("currency", "account_currency")
    return (
        transactions.join(customers, "customer_id", "left")
        .join(owned, "account_id", "left")
        .groupBy(*keys)
        .agg(rows().alias("tx_count"), total("amount").alias("total_amount"),
             F.avg("amount").alias("avg_amount"))
    )


def spend_by_account_type(
    transactions: DataFrame, customers: DataFrame, accounts: DataFrame,
    as_of: str | dt.date | None = None, days: int = TRANSACTION_LOOKBACK,
) -> DataFrame:
    """Spend per customer, segment, country and account type; with ``as_of`` only that of the
    ``days`` before it and that day, whose partitions are all that is read.

    Rows are summed per customer and account before the joins, so a hot customer meets the
    dimensions as a handful of rows, and both dimensions are pruned to what is asked for.
    """
    if as_of is not None:
        transactions = scan_lookback(transactions, as_of, days)
    spent = transactions.groupBy("customer_id", "account_id").agg(
        rows().alias("_n"), total("amount").alias("_amount")
    )
    grouped = (
        spent.join(accounts.select("account_id", "account_type"), "account_id", "left")
        .join(customers.select("customer_id", "segment", "country"), "customer_id", "left")
        .groupBy(*TYPE_KEYS)
        .agg(F.sum("_n").alias("tx_count"),
             F.sum("_amount").cast("decimal(28,2)").alias("total_amount"))
    )
    return grouped.withColumn(
        "avg_amount", mean_from(F.col("total_amount"), F.col("tx_count"))
    )

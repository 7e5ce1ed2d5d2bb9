"""Star schema views over silver: one fact table and its dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def date_key(column: str) -> Column:
    """``20240130`` for 2024-01-30."""
    return F.date_format(column, "yyyyMMdd").cast("int")


def merchant_key() -> Column:
    """Hash of the pair as JSON, which quotes texts and leaves NULL out: no two pairs share one."""
    return F.md5(F.to_json(F.struct("merchant", "merchant_category")))


def dim_date(transactions: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last event day."""
    span = transactions.agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last")
    ).filter(F.col("first").isNotNull())
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        date_key("date").alias("date_key"), "date", F.year("date").alias("year"),
        F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.day("date").alias("day"), (F.weekday("date") + 1).alias("day_of_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


def dim_merchant(transactions: DataFrame) -> DataFrame:
    pairs = transactions.filter(F.col("merchant").isNotNull())
    pairs = pairs.select("merchant", "merchant_category").distinct()
    return pairs.select(merchant_key().alias("merchant_key"), "merchant", "merchant_category")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "category", "interest_rate", "status", "minimum_balance",
        "created_at")


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "account_id", "customer_id", "account_type", "status", "balance", "currency", "created_at"
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "name", "age", "country", "segment", "email", "created_at"
    )


def fact_transactions(transactions: DataFrame) -> DataFrame:
    """Keys and measures; every key is computed from the row, so no join is needed."""
    return transactions.select(
        "transaction_id", "customer_id", "account_id", date_key("event_date").alias("date_key"),
        F.when(F.col("merchant").isNotNull(), merchant_key()).alias("merchant_key"),
        "transaction_type", "currency", "amount", "status", "payment_method", "is_late_arrival",
    )

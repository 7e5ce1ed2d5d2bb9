"""Readers of lake tables and entity files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgermill.functions.times import day

CUSTOMER_LOOKBACK = 90
TRANSACTION_LOOKBACK = 30


def scan_day(table: DataFrame, column: str, value: str | dt.date) -> DataFrame:
    """One partition day."""
    return table.filter(F.col(column) == day(value))


def scan_lookback(
    table: DataFrame, last: str | dt.date | Column, days: int, column: str = "event_date"
) -> DataFrame:
    """The closed range of ``days`` before ``last`` up to ``last``."""
    return table.filter(F.col(column).between(F.date_sub(day(last), days), day(last)))


def scan_staged(table: DataFrame, value: str | dt.date) -> DataFrame:
    """Rows by day of arrival, whatever day they belong to."""
    return scan_day(table, "processing_date", value)


def load_entities_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entity files, each one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def not_failed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") != "failed")


def open_status(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status").isin("completed", "pending"))


def has_payment(df: DataFrame) -> DataFrame:
    return df.filter(F.col("payment_method").isNotNull())

"""Report queries over the gold tables; ``as_of`` stands for the current day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.functions.measures import percent
from ledgermill.functions.times import day

Day = str | dt.date


def _money(column: str) -> Column:
    return F.round(column, 2).cast("decimal(28,2)")


def _snapshot(gold: DataFrame, as_of: Day) -> DataFrame:
    return gold.filter(F.col("process_date") == day(as_of))


def _since(gold: DataFrame, as_of: Day, days: int) -> DataFrame:
    return gold.filter(
        F.col("process_date").between(F.date_sub(day(as_of), days), day(as_of)))


def _grain(gold: DataFrame, granularity: str) -> DataFrame:
    return gold.filter(F.col("granularity") == granularity)


# --- customers ---------------------------------------------------------------------------


def customer_summary(gold: DataFrame, as_of: Day) -> DataFrame:
    return _snapshot(gold, as_of).select(
        "customer_id", "name", "country", "segment", "activity_tier", "total_transactions",
        _money("total_spend").alias("total_spend"),
        _money("avg_transaction_value").alias("avg_transaction_value"),
        _money("p95_transaction_value").alias("p95_transaction_value"),
        "active_days", "recency_days", "rfm_score", "last_transaction_at", "process_date",
    ).orderBy(F.desc("total_spend"), "customer_id")


def segment_distribution(gold: DataFrame, as_of: Day) -> DataFrame:
    return _snapshot(gold, as_of).groupBy("segment", "activity_tier").agg(
        F.count("customer_id").alias("customer_count"),
        _money(F.sum("total_spend")).alias("segment_total_spend"),
        _money(F.avg("avg_transaction_value")).alias("segment_avg_tx_value"),
        F.round(F.avg("rfm_score"), 2).alias("avg_rfm_score"),
    ).orderBy("segment", F.desc("customer_count"))


def top_customers(gold: DataFrame, as_of: Day, limit: int = 10) -> DataFrame:
    return (
        _snapshot(gold, as_of).orderBy(F.desc("total_spend"), "customer_id").limit(limit)
        .select(
            "customer_id", "name", "country", "segment",
            _money("total_spend").alias("total_spend"), "total_transactions",
            _money("avg_transaction_value").alias("avg_tx_value"), "activity_tier",
        )
    )


def churn_risk(gold: DataFrame, as_of: Day) -> DataFrame:
    return (
        _snapshot(gold, as_of).filter(F.col("activity_tier").isin("at_risk", "churned"))
        .select("customer_id", "name", "country", "segment", "recency_days", "frequency_score",
                "monetary_score", "rfm_score", "activity_tier", "last_transaction_at")
        .orderBy("rfm_score", F.desc("recency_days"), "customer_id")
    )


def activity_trend(gold: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    return _since(gold, as_of, days).groupBy("process_date", "activity_tier").agg(
        F.count("customer_id").alias("customer_count"),
        _money(F.sum("total_spend")).alias("total_spend"),
    ).orderBy("process_date", "activity_tier")


def new_vs_returning(gold: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    first, month_ago = F.col("first_transaction_at"), F.date_sub("process_date", 30)
    return _since(gold, as_of, days).groupBy("process_date").agg(
        F.count_if(first >= month_ago).alias("new_customers"),
        F.count_if(first < month_ago).alias("returning_customers"),
    ).orderBy("process_date")


# --- transactions ------------------------------------------------------------------------


def daily_summary(gold: DataFrame, as_of: Day) -> DataFrame:
    return _grain(_snapshot(gold, as_of), "daily_by_type").select(
        "event_date", "transaction_type", "currency", "tx_count",
        _money("total_volume").alias("total_volume"),
        _money("avg_amount").alias("avg_amount"),
        _money("p50_amount").alias("median_amount"),
        _money("p95_amount").alias("p95_amount"),
        _money("p99_amount").alias("p99_amount"),
        F.round(F.col("success_rate") * 100, 2).alias("success_rate_pct"),
        "failed_count", "late_arrival_count",
    ).orderBy(F.desc("event_date"), F.desc("total_volume"))


def _by_day_and_type(rows: DataFrame) -> DataFrame:
    return _grain(rows, "daily_by_type").groupBy("event_date", "transaction_type").agg(
        F.sum("tx_count").alias("tx_count"),
        _money(F.sum("total_volume")).alias("total_volume"),
        F.round(F.avg("success_rate") * 100, 2).alias("avg_success_rate_pct"),
    ).orderBy("event_date", "transaction_type")


def volume_trend(gold: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    """Over all snapshots of the period; an event day counts once per snapshot that holds it."""
    return _by_day_and_type(_since(gold, as_of, days))


def volume_trend_latest(gold: DataFrame, as_of: Day) -> DataFrame:
    """The same on one snapshot, each event day once."""
    return _by_day_and_type(_snapshot(gold, as_of))


def currency_breakdown(gold: DataFrame, as_of: Day) -> DataFrame:
    """Volume and share by currency; the total is taken over the few grouped rows."""
    volume = F.col("total_volume")
    share = volume / F.sum("total_volume").over(Window.partitionBy()) * 100
    return (
        _grain(_snapshot(gold, as_of), "daily_by_type").groupBy("currency")
        .agg(F.sum("tx_count").alias("total_transactions"),
             F.sum("total_volume").alias("total_volume"))
        .withColumn("volume_share_pct", F.round(share, 2).cast("decimal(10,2)"))
        .withColumn("total_volume", _money("total_volume"))
        .orderBy(F.desc("total_volume"))
    )


def failure_monitor(gold: DataFrame, as_of: Day) -> DataFrame:
    rate = F.try_divide(F.col("failed_count") * 100, F.col("tx_count"))
    status = F.when(rate > 5, "ALERT").when(rate > 2, "WARNING").otherwise("OK")
    return _grain(_snapshot(gold, as_of), "daily_by_type").select(
        "event_date", "transaction_type", "currency", "tx_count", "failed_count",
        F.round(rate, 2).alias("failure_rate_pct"), status.alias("status"),
    ).orderBy(F.desc("failure_rate_pct"), "event_date", "transaction_type", "currency")


def _by_hour_of_day(rows: DataFrame) -> DataFrame:
    return _grain(rows, "hourly").groupBy(
        F.hour("hour").alias("hour_of_day"), "transaction_type"
    ).agg(
        F.sum("tx_count").alias("total_tx_count"),
        _money(F.sum("total_volume")).alias("total_volume"),
        F.round(F.avg("tx_count"), 1).alias("avg_tx_per_day"),
    ).orderBy("hour_of_day", F.desc("total_tx_count"))


def peak_hours(gold: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    return _by_hour_of_day(_since(gold, as_of, days))


def peak_hours_latest(gold: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Event days of the last week, from one snapshot."""
    recent = F.col("event_date").between(F.date_sub(day(as_of), days), day(as_of))
    return _by_hour_of_day(_snapshot(gold, as_of).filter(recent))


def _late_by_day(rows: DataFrame) -> DataFrame:
    return _grain(rows, "daily_by_type").groupBy("event_date").agg(
        F.sum("tx_count").alias("total_tx"), F.sum("late_arrival_count").alias("late_arrivals"),
    ).withColumn(
        "late_rate_pct", percent(F.col("late_arrivals"), F.col("total_tx"))
    ).orderBy(F.desc("event_date"))


def late_impact(gold: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    return _late_by_day(_since(gold, as_of, days))


def late_impact_latest(gold: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    recent = F.col("event_date").between(F.date_sub(day(as_of), days), day(as_of))
    return _late_by_day(_snapshot(gold, as_of).filter(recent))


def dq_dashboard(metrics: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    return _since(metrics, as_of, days).select(
        "process_date", "check_name", "status",
        F.round(F.col("pass_rate") * 100, 4).alias("pass_rate_pct"),
        F.round(F.col("threshold") * 100, 2).alias("threshold_pct"),
        "failed_count", "total_count", "checked_at",
    ).orderBy(F.desc("process_date"), "status", "check_name")

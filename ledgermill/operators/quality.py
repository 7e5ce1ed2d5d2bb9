"""Data-quality checks: one pass over the data, any number of days at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgermill import schemas
from ledgermill.functions.measures import rows
from ledgermill.functions.times import day, instant
from ledgermill.operators.clean import lacks_critical

PASS_RATE = 0.99
# Name and least pass rate of each check, in report order.
CHECKS = {
    "completeness_critical_fields": 1.0,
    "validity_amount_positive": PASS_RATE,
    "validity_currency_known": PASS_RATE,
    "validity_status_known": 1.0,
    "referential_integrity_customer": PASS_RATE,
    "late_arrival_rate": 0.90,
    "freshness_2h": 1.0,
    "volume_anomaly": 1.0,
}
FRESH_HOURS = 2
HISTORY_DAYS = 7


def limits(thresholds: Mapping[str, float] | None = None) -> dict[str, float]:
    """Least pass rates, the given ones instead of the defaults."""
    unknown = set(thresholds or {}) - set(CHECKS)
    if unknown:
        raise ValueError(f"no such check: {', '.join(sorted(unknown))}")
    return CHECKS | dict(thresholds or {})


def dq_score(failed: Column, total: Column, threshold: Column) -> dict[str, Column]:
    """Pass rate (1 where there is nothing to check) and verdict; rounding is for show only."""
    rate = F.coalesce(F.try_divide((total - failed).cast("double"), total), F.lit(1.0))
    return {
        "status": F.when(rate >= threshold, "PASS").otherwise("FAIL"),
        "pass_rate": F.round(rate, 6),
    }


def failure_counts(
    transactions: DataFrame, customers: DataFrame | None, by: str = "event_date"
) -> DataFrame:
    """Per day: total, latest event, and failed rows of every row-level check.

    Rows are first counted per day and customer, so the referential check joins counts and not
    rows and a hot customer is one row per task.
    """
    currency, status = F.col("currency"), F.col("status")
    failed = {
        "completeness_critical_fields": lacks_critical(),
        "validity_amount_positive": F.col("amount") <= 0,
        "validity_currency_known": ~currency.isin(schemas.CURRENCIES),
        "validity_status_known": ~status.isin(schemas.STATUSES + ["unknown"]),
        "late_arrival_rate": F.col("is_late_arrival"),
    }
    partial = transactions.groupBy(by, "customer_id").agg(
        rows().alias("total"),
        F.max("timestamp").alias("latest"),
        *[F.count_if(test).alias(name) for name, test in failed.items()],
    )
    sums = ["total", *failed]
    if customers is not None:
        known = customers.select("customer_id").distinct().withColumn("_known", F.lit(True))
        partial = partial.join(known, "customer_id", "left").withColumn(
            "referential_integrity_customer",
            F.when(F.col("_known").isNull(), F.col("total")).otherwise(F.lit(0)),
        )
        sums.append("referential_integrity_customer")
    return partial.groupBy(by).agg(
        F.max("latest").alias("latest"), *[F.sum(c).alias(c) for c in sums]
    )


def dq_report(
    transactions: DataFrame,
    customers: DataFrame | None = None,
    as_of: Column | str | None = None,
    by: str = "event_date",
    thresholds: Mapping[str, float] | None = None,
    volume: DataFrame | None = None,
) -> DataFrame:
    """All checks in long form, one row per day and check.

    ``as_of`` is the moment of checking (now by default); it may use the day column. ``volume`` is
    what ``dq_volume`` found; only its check has a line for days without rows.
    """
    now = F.current_timestamp() if as_of is None else instant(as_of)
    least = limits(thresholds)
    counted = failure_counts(transactions, customers, by)
    stale = F.col("latest").isNull() | (
        F.col("latest") < now - F.make_dt_interval(hours=F.lit(FRESH_HOURS))
    )
    names = [c for c in CHECKS if c in counted.columns]
    lines = [
        F.struct(F.lit(c).alias("check_name"), F.lit(least[c]).alias("threshold"),
                 F.col(c).alias("failed_count"), F.col("total").alias("total_count"))
        for c in names
    ]
    lines.append(
        F.struct(F.lit("freshness_2h").alias("check_name"),
                 F.lit(least["freshness_2h"]).alias("threshold"),
                 stale.cast("bigint").alias("failed_count"),
                 F.lit(1).cast("bigint").alias("total_count"))
    )
    found = counted.select(
        F.col(by).alias("process_date"), now.alias("checked_at"), F.inline(F.array(*lines)))
    if volume is not None:
        found = found.unionByName(
            volume.withColumnRenamed("process_date", by).select(
                F.col(by).alias("process_date"), now.alias("checked_at"),
                F.lit("volume_anomaly").alias("check_name"),
                F.lit(least["volume_anomaly"]).alias("threshold"),
                (F.col("status") == "FAIL").cast("bigint").alias("failed_count"),
                F.lit(1).cast("bigint").alias("total_count")))
    return (
        found
        .withColumns(dq_score(F.col("failed_count"), F.col("total_count"), F.col("threshold")))
        .select("check_name", "status", "pass_rate", "threshold", "failed_count", "total_count",
                "process_date", "checked_at")
    )


def dq_check(report: DataFrame, name: str) -> DataFrame:
    return report.filter(F.col("check_name") == name)


def dq_gate(metrics: DataFrame) -> DataFrame:
    """One row: may the day proceed? True where nothing failed, also where nothing ran."""
    verdict = F.coalesce(F.bool_and(F.col("status") != "FAIL"), F.lit(True))
    return metrics.agg(
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"),
        verdict.alias("gate_passed"),
    )


def dq_gate_by_day(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("process_date").agg(
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"),
        F.bool_and(F.col("status") != "FAIL").alias("gate_passed"),
    )


def bronze_freshness(bronze: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """One row: latest arrival and whether it lies within two hours; none in reach is stale.

    Only the arrival days that those hours touch are read; ``latest_ts`` is NULL where they are
    empty.
    """
    now = F.current_timestamp() if as_of is None else instant(as_of)
    limit = now - F.make_dt_interval(hours=F.lit(FRESH_HOURS))
    recent = bronze.filter(F.col("ingestion_date") >= limit.cast("date"))
    return recent.agg(F.max("ingestion_timestamp").alias("latest_ts")).withColumn(
        "is_fresh", F.coalesce(F.col("latest_ts") >= limit, F.lit(False))
    )


def dq_volume(
    transactions: DataFrame, by: str = "event_date", history: int = HISTORY_DAYS,
    width: float = 3.0, last: str | dt.date | None = None,
) -> DataFrame:
    """Per calendar day: row count against mean ± ``width`` deviations of the days before it.

    Days run from the first that has rows to ``last``, or to the last that has rows; one without
    rows counts zero, in its own line and as history. A day with less history passes. Each day's
    count is sent to the days it is history for; no window over all days is needed.
    """
    counted = transactions.groupBy(by).agg(rows().alias("total_count"))
    end = F.max(by) if last is None else F.greatest(F.max(by), day(last))
    span = counted.agg(F.min(by).alias("first"), end.alias("end")).filter("first IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("first", "end")).alias(by))
    counts = calendar.join(counted, by, "left").select(
        by, F.coalesce("total_count", F.lit(0)).alias("total_count"))
    exact = F.col("total_count").cast("decimal(38,0)")
    past = (
        counts.select(
            F.explode(F.sequence(F.date_add(by, 1), F.date_add(by, history))).alias(by),
            exact.alias("_c"),
        )
        .groupBy(by)
        .agg(rows().alias("history_days"), F.sum("_c").cast("decimal(38,0)").alias("_s"),
             F.sum(F.col("_c") * F.col("_c")).cast("decimal(38,0)").alias("_q"))
    )
    n = F.col("history_days").cast("decimal(10,0)")
    spread = F.sqrt((F.col("_q") * n - F.col("_s") * F.col("_s")).cast("double"))
    mean = F.col("_s").cast("double") / F.col("history_days")
    deviation = spread / F.col("history_days")
    usual = F.col("total_count").between(F.col("lower_bound"), F.col("upper_bound"))
    return (
        counts.join(past, by, "left")
        .withColumns({
            "history_days": F.coalesce("history_days", F.lit(0)),
            "lower_bound": mean - F.lit(width) * deviation,
            "upper_bound": mean + F.lit(width) * deviation,
        })
        .withColumn("status", F.when((F.col("history_days") < history) | usual, "PASS")
                    .otherwise("FAIL"))
        .select(F.col(by).alias("process_date"), "total_count", "history_days", "lower_bound",
                "upper_bound", "status")
    )

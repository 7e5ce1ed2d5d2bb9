"""Scores, checks, gate, freshness, volume."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import at, transaction
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import quality


@pytest.mark.parametrize("total, failed, threshold, status, rate", [
    (1000, 5, 0.99, "PASS", 0.995), (1000, 20, 0.99, "FAIL", 0.98), (500, 0, 1.0, "PASS", 1.0),
    (0, 0, 0.99, "PASS", 1.0),
    # The verdict precedes rounding.
    (10_000_000, 1, 1.0, "FAIL", 1.0),
])
def test_score(spark, total, failed, threshold, status, rate):
    row = spark.range(1).select(*[
        c.alias(n) for n, c in quality.dq_score(
            F.lit(failed), F.lit(total), F.lit(threshold)).items()]).first()
    assert (row["status"], row["pass_rate"]) == (status, rate)


def metrics(spark, *statuses):
    rows = [("c", s, 1.0, 1.0, 0, 1, dt.date(2024, 1, 15), None) for s in statuses]
    return spark.createDataFrame(rows, schemas.DQ_METRICS)


@pytest.mark.parametrize("statuses, passed", [
    (["PASS", "PASS"], True), (["PASS", "FAIL"], False), ([], True)])
def test_gate(spark, statuses, passed):
    assert quality.dq_gate(metrics(spark, *statuses)).first()["gate_passed"] is passed


@pytest.fixture
def day(frame):
    rows = [transaction(i, timestamp=at(23, 30)) for i in range(96)]
    rows += [transaction(96, amount=Decimal("0")), transaction(97, currency=None),
             transaction(98, currency="XXX", is_late_arrival=True),
             transaction(99, merchant=None, customer_id="ghost")]
    return frame(*rows).withColumn("event_date", F.to_date("timestamp"))


def test_report(spark, day):
    known = spark.createDataFrame([(f"CUS{i:03d}",) for i in range(100)], "customer_id string")
    report = {r["check_name"]: r for r in quality.dq_report(day, known, "2024-01-16").collect()}
    assert set(report) == set(quality.CHECKS) - {"volume_anomaly"}
    failed = {name: r["failed_count"] for name, r in report.items()}
    assert failed == {
        "completeness_critical_fields": 0, "validity_amount_positive": 1,
        "validity_currency_known": 1,  # NULL is not counted
        "validity_status_known": 0, "referential_integrity_customer": 1, "late_arrival_rate": 1,
        "freshness_2h": 0}
    assert {r["total_count"] for n, r in report.items() if n != "freshness_2h"} == {100}
    assert report["freshness_2h"]["total_count"] == 1
    assert {r["status"] for r in report.values()} == {"PASS"}


def test_stale_day_and_missing_dimension(day):
    report = {r["check_name"]: r["status"]
              for r in quality.dq_report(day, as_of="2024-01-16 01:30:01").collect()}
    assert report["freshness_2h"] == "FAIL"
    assert "referential_integrity_customer" not in report


def test_duplicated_dimension_rows_do_not_count_twice(spark, day):
    known = spark.createDataFrame([("CUS000",), ("CUS000",)], "customer_id string")
    rows = quality.dq_check(quality.dq_report(day, known), "referential_integrity_customer")
    assert rows.first()[4:6] == (99, 100)


def test_empty_day_has_no_lines(day):
    report = quality.dq_report(day.limit(0))
    assert report.count() == 0
    assert quality.dq_gate(report).first()["gate_passed"] is True


def test_bronze_freshness(day):
    day = day.withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    fresh = quality.bronze_freshness(day, at(14)).first()
    stale = quality.bronze_freshness(day, at(14, 0, 1)).first()
    empty = quality.bronze_freshness(day.limit(0), at(14)).first()
    assert (fresh["is_fresh"], stale["is_fresh"], empty["is_fresh"]) == (True, False, False)


def test_volume(spark):
    counts = [10, 12, 11, 10, 12, 11, 10, 11, 40]
    rows = [(dt.date(2024, 1, 1 + d),) for d, n in enumerate(counts) for _ in range(n)]
    verdicts = quality.dq_volume(spark.createDataFrame(rows, "event_date date"))
    found = verdicts.orderBy("process_date").collect()
    assert found[0]["status"] == "PASS" and found[0]["history_days"] == 0
    assert found[-1]["status"] == "FAIL" and found[-2]["status"] == "PASS"
    assert found[-1]["history_days"] == 7


def days_of(spark, counts):
    rows = [(dt.date(2024, 1, 1 + d),) for d, n in enumerate(counts) for _ in range(n)]
    return spark.createDataFrame(rows, "event_date date")


def test_a_day_without_rows_is_an_anomaly(spark):
    volume = quality.dq_volume(days_of(spark, [10, 12, 11, 10, 12, 11, 10, 0, 11]))
    found = {r["process_date"].day: r for r in volume.collect()}
    assert (found[8]["total_count"], found[8]["status"]) == (0, "FAIL")
    assert found[9]["status"] == "PASS" and len(found) == 9
    after = quality.dq_volume(days_of(spark, [10] * 8), last="2024-01-10")
    assert [r["total_count"] for r in after.orderBy("process_date").collect()][-2:] == [0, 0]
    assert quality.dq_volume(days_of(spark, [1]).limit(0)).count() == 0


def test_little_history_passes(spark):
    volume = quality.dq_volume(days_of(spark, [10, 500, 10]))
    assert {r["status"] for r in volume.collect()} == {"PASS"}


def test_volume_in_report_and_gate(frame, spark):
    rows = [transaction(d * 20 + i, timestamp=at(10, day=1 + d)) for d in range(8)
            for i in range(10 if d < 7 else 1)]
    df = frame(*rows).withColumn("event_date", F.to_date("timestamp"))
    report = quality.dq_report(df, as_of="2024-01-08 11:00:00", volume=quality.dq_volume(df))
    lines = quality.dq_check(report, "volume_anomaly")
    assert {r["process_date"].day: r["status"] for r in lines.collect()} == {
        d: "FAIL" if d == 8 else "PASS" for d in range(1, 9)}
    gates = {r["process_date"].day: r["failed_checks"] for r in quality.dq_gate_by_day(
        lines).collect()}
    assert gates == {d: int(d == 8) for d in range(1, 9)}


def test_thresholds_are_parameters(day):
    strict = quality.dq_report(day, thresholds={"validity_currency_known": 1.0})
    line = quality.dq_check(strict, "validity_currency_known").first()
    assert (line["status"], line["threshold"]) == ("FAIL", 1.0)
    with pytest.raises(ValueError):
        quality.limits({"validity_colour": 1.0})

"""Parsing, validation, normalisation, quarantine reasons."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from conftest import at, transaction
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import clean
from ledgermill.plans import profile

GOOD = {
    "transaction_id": " TXN1 ", "account_id": "ACC1", "customer_id": "CUS1 ",
    "transaction_type": " Purchase", "amount": 12.5, "currency": " usd ", "merchant": "M",
    "merchant_category": "fuel", "timestamp": "2024-01-15T10:00:00.123456", "status": "COMPLETED",
}


@pytest.fixture
def bronze(spark):
    def build(*payloads, arrived=at(10, 5)):
        rows = [
            ("k", p if p is None or isinstance(p, str) else json.dumps(p), "t", 0, i, arrived,
             arrived, arrived.date())
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, schemas.BRONZE)

    return build


def by_offset(df):
    return {r["kafka_offset"]: r for r in df.collect()}


def test_payload_versions_and_damage(bronze):
    v2 = GOOD | {"payment_method": "pix"}
    v3 = v2 | {"device_fingerprint": "f", "ip_country": "BR", "_is_late_arrival": True}
    rows = by_offset(clean.parse_payload(bronze(
        GOOD, v2, v3, GOOD | {"amount": "abc"}, "no json", None, GOOD | {"customer_id": None},
        GOOD | {"amount": "7.5"}, GOOD | {"amount": 12.345},
    )))
    assert len(rows) == 9
    assert rows[0]["payment_method"] is None and rows[1]["payment_method"] == "pix"
    assert rows[2]["ip_country"] == "BR" and rows[2]["_is_late_arrival"] == "true"
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 15, 10, 0, 0, 123456)
    assert rows[3]["amount"] is None and rows[3]["transaction_id"] == " TXN1 "
    assert rows[4]["transaction_id"] is None and rows[5]["transaction_id"] is None
    assert rows[6]["customer_id"] is None
    assert rows[7]["amount"] == Decimal("7.50") and rows[8]["amount"] == Decimal("12.35")


def test_every_row_is_valid_or_quarantined(bronze):
    parsed = clean.parse_payload(
        bronze(GOOD, "no json", None, GOOD | {"timestamp": None}, GOOD | {"amount": "x"}),
        keep_raw=True)
    valid, rejected = clean.split_valid(parsed), clean.split_quarantine(parsed)
    assert valid.count() == 1 and rejected.count() == 4
    assert {r["quarantine_reason"] for r in rejected.collect()} == {"null_critical_field"}
    assert "no json" in {r["raw_payload"] for r in rejected.collect()}
    routed = clean.route(parsed).groupBy("is_valid").count().collect()
    assert dict(map(tuple, routed)) == {True: 1, False: 4}


def test_cleaned_row(bronze):
    row = clean.clean_transactions(bronze(GOOD | {"amount": -3})).first()
    assert (row["transaction_id"], row["customer_id"], row["transaction_type"]) == (
        "TXN1", "CUS1", "purchase")
    assert (row["currency"], row["status"], row["amount"]) == ("USD", "completed", Decimal("3.00"))
    assert row["event_date"] == row["processing_date"] == dt.date(2024, 1, 15)
    assert row["is_late_arrival"] is False


def test_sample_counts(sample):
    assert sample.filter(clean.lacks_critical()).count() == 2
    assert sample.filter("amount <= 0").count() == 1
    assert clean.split_valid(sample).filter("amount > 0").count() == 5
    assert sample.filter("is_late_arrival").count() == 1
    assert clean.amount_abs(sample).filter("amount < 0").count() == 0


def test_unknown_codes(frame):
    rows = clean.guard_enums(frame(
        transaction(1, currency="XYZ", status="reversed"), transaction(2, currency=None,
                                                                      status=None),
        transaction(3, transaction_type="gift"))).collect()
    assert [(r["currency"], r["status"]) for r in rows] == [
        ("UNKNOWN", "unknown"), ("UNKNOWN", "unknown"), ("USD", "completed")]
    assert rows[2]["transaction_type"] == "gift"


def test_late_is_strictly_more_than_half_an_hour(frame):
    flagged = clean.flag_late(frame(
        transaction(1, timestamp=at(11, 30)), transaction(2, timestamp=at(11, 29, 59))))
    assert [r["is_late_arrival"] for r in flagged.orderBy("transaction_id").collect()] == [
        False, True]


def test_first_failing_rule(frame):
    rows = by_offset(clean.decision_tree(frame(
        transaction(1, 0),
        transaction(1, 1, ingestion_timestamp=at(13)),
        transaction(2, 2, transaction_id=None, customer_id=None),
        transaction(3, 3, customer_id=None, amount=Decimal("-1")),
        transaction(4, 4, amount=Decimal("0"), timestamp=None),
        transaction(5, 5, timestamp=None, currency="XXX"),
        transaction(6, 6, currency="XXX"),
        transaction(6, 7, ingestion_timestamp=at(13)),
    )))
    assert [rows[i]["quarantine_reason"] for i in range(8)] == [
        None, "duplicate", "missing_transaction_id", "missing_customer_id", "invalid_amount",
        "missing_timestamp", "invalid_currency", None]


def test_versions_unify(spark):
    old = spark.createDataFrame([("a",)], "transaction_id string")
    new = spark.createDataFrame([("b", "BR")], "transaction_id string, ip_country string")
    rows = clean.unify_versions(old, new).orderBy("transaction_id").collect()
    assert [tuple(r) for r in rows] == [("a", None), ("b", "BR")]


def test_tags(sample):
    tagged = clean.tag_rows(sample, risk_level="HIGH", twice=F.col("amount") * 2)
    assert tagged.filter("risk_level = 'HIGH' AND twice = amount * 2").count() == 8


def test_tally(bronze):
    counts = dict(map(tuple, profile.tally(bronze(
        GOOD, GOOD | {"transaction_id": None, "_is_late_arrival": True}, "no json",
        {"amount": 1})).collect()))
    assert counts == {
        "total": 3, "parse_errors": 1, "late_arrivals": 1, "null_transaction_id": 2,
        "status_COMPLETED": 2, "status_unknown": 1, "type_ Purchase": 2, "type_unknown": 1}

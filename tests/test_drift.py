"""Unknown payload fields."""

import datetime as dt
import json

import pytest

from ledgermill import schemas
from ledgermill.operators import clean, drift

DAY, NEXT = dt.date(2024, 1, 15), dt.date(2024, 1, 16)


@pytest.fixture
def bronze(spark):
    base = {"transaction_id": "T", "customer_id": "C", "account_id": "A", "amount": 5, "timestamp": "2024-01-15T01:00:00"}
    payloads = [
        (DAY, base), (DAY, base | {"channel": "web"}), (DAY, base | {"channel": 7, "geo": {"lat": 1.5}}),
        (NEXT, base | {"channel": None}), (NEXT, [1, 2]), (NEXT, None), (NEXT, "text only"),
    ]
    rows = [("k", p if isinstance(p, str) or p is None else json.dumps(p), "t", 0, n, dt.datetime(2024, 1, 15),
             dt.datetime(2024, 1, 15), day) for n, (day, p) in enumerate(payloads)]
    return spark.createDataFrame(rows, schemas.BRONZE)


def test_unknown_fields_are_kept(bronze):
    parsed = drift.parse_with_extra(bronze)
    assert parsed.drop("extra").columns == clean.parse_payload(bronze).columns
    extra = {r["kafka_offset"]: r["extra"] for r in parsed.select("kafka_offset", "extra").collect()}
    assert extra == {0: None, 1: {"channel": '"web"'}, 2: {"channel": "7", "geo": '{"lat":1.5}'},
                     3: {"channel": "null"}, 4: None, 5: None, 6: None}
    assert parsed.filter("transaction_id = 'T'").count() == 4


def test_unknown_fields_are_reported(bronze):
    report = {(r["ingestion_date"], r["field"]): (r["kind"], r["row_count"]) for r in drift.drift_report(bronze).collect()}
    assert report == {
        (DAY, "channel"): ("VARIANT", 2), (DAY, "geo"): ("OBJECT<lat: DECIMAL(2,1)>", 1), (NEXT, "channel"): ("VOID", 1)}


def test_nothing_unknown_gives_no_line(bronze):
    assert drift.drift_report(bronze.filter("kafka_offset = 0")).count() == 0
    assert drift.drift_report(bronze.limit(0)).count() == 0

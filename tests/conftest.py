"""Session and example rows shared by the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ledgermill.session import build_session
from ledgermill.workspace import drop_workspace

SILVER = (
    "transaction_id string, account_id string, customer_id string, transaction_type string, "
    "amount decimal(18,2), currency string, merchant string, status string, "
    "timestamp timestamp, payment_method string, is_late_arrival boolean, "
    "ingestion_timestamp timestamp, kafka_partition int, kafka_offset bigint"
)
NOON = dt.datetime(2024, 1, 15, 12)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_workspace(session)
    session.stop()


def at(hour: int, minute: int = 0, second: int = 0, day: int = 15) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour, minute, second)


def transaction(number, offset=0, **changes):
    """One silver-shaped row as a dict; fields may be overridden."""
    row = {
        "transaction_id": f"TXN{number:03d}", "account_id": f"ACC{number:03d}",
        "customer_id": f"CUS{number:03d}", "transaction_type": "purchase",
        "amount": Decimal("10.00"), "currency": "USD", "merchant": "Corner Shop",
        "status": "completed", "timestamp": at(10), "payment_method": "credit_card",
        "is_late_arrival": False, "ingestion_timestamp": NOON, "kafka_partition": 0,
        "kafka_offset": offset,
    }
    return row | changes


@pytest.fixture
def frame(spark):
    """Builds a silver-shaped frame from rows."""
    names = [field.split()[0] for field in SILVER.split(", ")]

    def build(*rows):
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SILVER)

    return build


@pytest.fixture
def sample(frame):
    """Eight rows: a repeated id, a negative amount, two missing ids, a late row."""
    first = transaction(1, 0, amount=Decimal("150.00"))
    return frame(
        first,
        transaction(2, 1, account_id="ACC001", customer_id="CUS001", amount=Decimal("25.50")),
        transaction(3, 2, transaction_type="transfer", amount=Decimal("500.00"), currency="EUR",
                    merchant=None),
        transaction(4, 3, transaction_type="withdrawal", amount=Decimal("-50.00"),
                    merchant=None, status="failed"),
        first | {"kafka_offset": 4},
        transaction(7, 5, transaction_id=None, amount=Decimal("75.00")),
        transaction(5, 6, customer_id=None, amount=Decimal("30.00")),
        transaction(6, 7, currency="BRL", amount=Decimal("200.00"), is_late_arrival=True),
    )

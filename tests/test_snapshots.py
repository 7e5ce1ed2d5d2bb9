"""Snapshots of several days: aggregated once, built once, nothing large by way of the driver."""

import datetime as dt

from conftest import transaction
from pyspark.sql import functions as F

from ledgermill import catalog
from ledgermill.plans import customers as cust
from ledgermill.plans import transactions as tx
from ledgermill.workspace import stage


def ledger(frame):
    rows = [transaction(i, customer_id=f"C{i % 5}", merchant=f"m{i % 4}" if i % 9 else None,
                        currency="USD" if i % 2 else "EUR",
                        timestamp=dt.datetime(2024, 1, 30, i % 24) - dt.timedelta(i % 70))
            for i in range(300)]
    return frame(*rows).withColumns({
        "event_date": F.to_date("timestamp"), "merchant_category": F.lit("fuel")})


def test_snapshots_from_one_aggregate_equal_those_from_the_ledger(frame):
    silver = stage(ledger(frame), "snapshot-silver", "event_date")
    dates = ["2023-12-20", "2024-01-15", "2024-01-30", "2024-03-20"]
    found = tx.gold_transactions_snapshots(silver, dates)
    assert list(found) == dates
    for d in dates:
        want = tx.gold_transactions_union(silver, d)
        assert found[d].columns == want.columns
        assert sorted(map(str, found[d].collect())) == sorted(map(str, want.collect()))


def test_the_ledger_is_aggregated_once_and_each_snapshot_built_once(spark, monkeypatch):
    calls = []
    count = lambda name, real: lambda *a: calls.append(name) or real(*a)
    monkeypatch.setattr(tx, "volume_base", count("base", tx.volume_base))
    monkeypatch.setattr(cust, "gold_customers", count("customers", cust.gold_customers))
    tables = catalog.Tables(spark, "/root/testdata/sf0.001")
    assert tables.gold_transactions.count() > 0 and tables.gold_customers.count() > 0
    assert calls == ["base"] + ["customers"] * len(catalog.SNAPSHOT_DATES)


def test_the_customer_dimension_does_not_pass_through_the_driver(spark):
    per_customer = spark.range(20).select(F.format_string("C%d", "id").alias("customer_id"))
    known = stage(per_customer.filter("customer_id <> 'C3'").select(
        "customer_id", *(F.lit("x").alias(c) for c in cust.CUSTOMER_COLUMNS[1:])), "known")
    joined = cust.with_customer(stage(per_customer, "per-customer"), known)
    assert joined.count() == 20 and joined.filter("name is null").count() == 1
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()

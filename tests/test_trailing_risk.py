"""Trailing windows against brute force, and the risk signals."""

import datetime as dt
import random
from decimal import Decimal

from conftest import at, transaction
from pyspark.sql import functions as F

from ledgermill.operators import trailing
from ledgermill.plans import lookups, risk

CUSTOMERS = "customer_id string, country string, segment string"


def test_trailing_count_matches_brute_force(spark):
    """One account holds a third of the rows, with several rows in the same second."""
    chance = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, "hot" if i % 3 == 0 else f"a{chance.randrange(20)}",
         start + dt.timedelta(milliseconds=chance.randrange(4_000_000)))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "n int, account_id string, timestamp timestamp")
    for span in (1, 60, 600, 100_000):
        ours = {r["n"]: r["c"] for r in trailing.with_trailing_count(
            df, "c", seconds=span).collect()}
        second = {n: int((t - start).total_seconds()) for n, _, t in rows}
        for n, account, _ in rows:
            expected = sum(1 for m, a, _ in rows
                           if a == account and 0 <= second[n] - second[m] <= span)
            assert ours[n] == expected, (span, n)


def test_window_is_closed_at_both_ends(frame):
    df = frame(*[transaction(i, account_id="A", timestamp=t) for i, t in enumerate(
        [at(10), at(10, 10), at(10, 10, 1), at(10, 20, 1)])])
    counts = trailing.with_trailing_count(df, "c").orderBy("timestamp").collect()
    assert [r["c"] for r in counts] == [1, 2, 2, 2]


def test_velocity_needs_more_than_five(frame):
    burst = [transaction(i, account_id="A", customer_id="C", timestamp=at(10, i)) for i in range(7)]
    calm = [transaction(20 + i, account_id="B", timestamp=at(10, i)) for i in range(5)]
    spread = [transaction(40 + i, account_id="D", timestamp=at(10 + i)) for i in range(8)]
    alerts = risk.velocity_alerts(frame(*burst, *calm, *spread)).collect()
    assert len(alerts) == 1
    row = alerts[0]
    assert (row["account_id"], row["customer_id"], row["max_tx_in_window"],
            row["flagged_transactions"], row["flagged_amount"], row["latest_flagged_at"],
            row["risk_level"]) == ("A", "C", 7, 2, Decimal("20.00"), at(10, 6), "HIGH")


def test_velocity_counts_the_account_over_its_customers(frame):
    rows = [transaction(i, account_id="A", customer_id=f"C{i % 2}", timestamp=at(10, i))
            for i in range(6)]
    alerts = risk.velocity_alerts(frame(*rows)).collect()
    assert [(r["customer_id"], r["max_tx_in_window"]) for r in alerts] == [("C1", 6)]


def test_outsized_levels(frame):
    small = [transaction(i, customer_id="C", amount=Decimal("1")) for i in range(30)]
    large = transaction(90, customer_id="C", amount=Decimal("100"))
    flags = risk.large_tx_flags(frame(*small, large)).collect()
    assert [(r["transaction_id"], r["risk_level"]) for r in flags] == [("TXN090", "CRITICAL")]
    assert flags[0]["customer_avg_amount"] == Decimal("4.193548")


def test_trailing_mean_forgets_old_days(frame):
    rows = frame(
        transaction(1, customer_id="C", amount=Decimal("100"), timestamp=dt.datetime(2023, 10, 1)),
        *[transaction(10 + i, customer_id="C", amount=Decimal("1"), timestamp=at(1, day=2 + i))
          for i in range(5)],
        transaction(50, customer_id="C", amount=Decimal("30"), timestamp=at(1, day=20)),
    ).withColumn("event_date", F.to_date("timestamp"))
    assert risk.large_tx_flags(rows).count() == 1
    trailing_flags = risk.large_tx_flags_trailing(rows).collect()
    assert [(r["transaction_id"], r["customer_avg_amount"]) for r in trailing_flags] == [
        ("TXN050", Decimal("5.833333"))]


def test_orphans(spark, frame):
    rows = frame(transaction(1), transaction(2), transaction(3, customer_id=None),
                 transaction(2, 1, transaction_id="T9"))
    known = spark.createDataFrame([("CUS001", "BR", "retail")], CUSTOMERS)
    found = lookups.orphans(rows, known)
    assert sorted(r["transaction_id"] for r in found.collect()) == ["T9", "TXN002", "TXN003"]
    assert found.columns == rows.columns


def test_geo_and_exposure(spark, frame):
    customers = spark.createDataFrame(
        [("CUS001", "BR", "retail"), ("CUS002", None, "sme")], CUSTOMERS)
    rows = frame(
        transaction(1), transaction(1, 1, transaction_id="T2"), transaction(2), transaction(3),
        transaction(1, 2, transaction_id="T3", status="failed"),
    ).withColumn("ip_country", F.when(F.col("transaction_id") != "T2", "US").otherwise("BR"))
    geo = risk.geo_anomalies(rows, customers).collect()
    assert [(r["customer_id"], r["ip_country"], r["anomalous_tx_count"]) for r in geo] == [
        ("CUS001", "US", 2)]
    exposure = risk.currency_exposure(rows, customers).orderBy("segment").collect()
    assert [(r["segment"], r["transaction_count"], r["customer_count"]) for r in exposure] == [
        ("retail", 2, 1), ("sme", 1, 1)]


def test_failure_rate_limits(frame):
    def account(name, failed, total, start):
        return [transaction(start + i, account_id=name, customer_id="C",
                            status="failed" if i < failed else "completed") for i in range(total)]

    flags = risk.failure_rate_flags(frame(
        *account("at-limit", 1, 5, 0), *account("above", 2, 5, 10), *account("few", 4, 4, 20)))
    assert [(r["account_id"], r["failed_tx"]) for r in flags.collect()] == [("above", 2)]


def test_signals_share_one_shape(spark, frame):
    customers = spark.createDataFrame([("CUS001", "BR", "retail")], CUSTOMERS)
    rows = frame(transaction(1)).withColumn("ip_country", F.lit("US"))
    signals = risk.risk_signals(rows, customers, "2024-01-15")
    assert {r["risk_signal"] for r in signals.collect()} == {"geo_anomaly", "currency_exposure"}
    assert signals.columns == [*risk.SIGNAL_COLUMNS, "process_date"]


def test_levels_at_the_bounds_are_exact(frame):
    """Exactly ten and five times the mean are not above it; in doubles 2.35 / 0.235 would be."""
    means = [(f"C{i}", Decimal(m)) for i, m in enumerate(
        ["0.235000", "0.235000", "0.470000", "0.500000"])]
    rows = [transaction(i, customer_id=f"C{i}", amount=Decimal(a)) for i, a in enumerate(
        ["2.35", "2.36", "2.35", "2.51"])]
    df = frame(*rows)
    known = df.sparkSession.createDataFrame(
        means, "customer_id string, customer_avg_amount decimal(22,6)")
    found = {r["customer_id"]: r for r in risk._outsized(df, known, ["customer_id"]).collect()}
    assert {c: r["risk_level"] for c, r in found.items()} == {
        "C0": "HIGH", "C1": "CRITICAL", "C2": "MEDIUM", "C3": "HIGH"}
    assert found["C0"]["amount_vs_avg_ratio"] == 10


def test_a_burst_over_midnight_is_flagged(spark, frame):
    start = dt.datetime(2024, 1, 15, 23, 57)
    burst = [transaction(i, account_id="A", customer_id="C",
                         timestamp=start + dt.timedelta(minutes=i)) for i in range(7)]
    old = [transaction(50 + i, account_id="A", customer_id="C", timestamp=at(12, i))
           for i in range(9)]
    df = frame(*burst, *old).withColumn("event_date", F.to_date("timestamp"))
    people = spark.createDataFrame([("C", "BR", "retail")], CUSTOMERS)
    signals = risk.risk_signals_of_day(
        df.withColumn("ip_country", F.lit("BR")), people, "2024-01-16")
    velocity = signals.filter("risk_signal = 'velocity_alert'").collect()
    # Three of the seven lie before midnight; the two last ones see six and seven.
    assert [(r["account_id"], r["flagged_amount"]) for r in velocity] == [("A", Decimal("20.00"))]


def test_a_day_is_measured_by_the_month(spark, frame):
    usual = [transaction(i, customer_id="C", timestamp=at(10, day=1 + i)) for i in range(14)]
    large = transaction(99, customer_id="C", amount=Decimal("60.00"), timestamp=at(10))
    df = frame(*usual, large).withColumn("event_date", F.to_date("timestamp"))
    people = spark.createDataFrame([("C", "BR", "retail")], CUSTOMERS)
    signals = risk.risk_signals_of_day(
        df.withColumn("ip_country", F.lit("BR")), people, "2024-01-15")
    found = signals.filter("risk_signal = 'large_transaction'").collect()
    assert [(r["transaction_id"], r["risk_level"]) for r in found] == [("TXN099", "MEDIUM")]

"""Daily states against the ledger."""

import pytest
from pyspark.sql import functions as F, types as T

from ledgermill import schemas
from ledgermill.operators import tables
from ledgermill.plans import customers, rollups
from ledgermill.workspace import new_path
from silver_rows import silver_rows

DAYS = ["2024-01-10", "2024-01-11", "2024-02-02"]


def varied(spark, day, n=400):
    """Rows of one day: a third from one customer, amounts spread, some failed, many merchants."""
    x = F.pmod(F.xxhash64("transaction_id", F.lit(day)), F.lit(1000))
    hot = F.when(x % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (x % 17).cast("string")))
    return silver_rows(spark, range(n), day=day).withColumns({
        "amount": (x * 7 + 1).cast("decimal(18,2)"), "customer_id": hot,
        "account_id": F.concat("customer_id", (x % 4).cast("string")),
        "status": F.when(x % 11 == 0, "failed").otherwise("completed"),
        "transaction_type": F.when(x % 2 == 0, "purchase").otherwise("transfer"),
        "currency": F.lit("USD"), "merchant_category": F.concat(F.lit("k"), (x % 2).cast("string")),
        "merchant": F.when(x % 29 > 0, F.concat(F.lit("m"), (x % 90).cast("string"))),
        "timestamp": F.lit(f"{day} 00:00:00").cast("timestamp") + F.make_dt_interval(secs=x),
    })


@pytest.fixture
def silver(spark):
    path = new_path(spark, "silver")
    for day in DAYS:
        tables.append(varied(spark, day), path, "event_date")
    return path


def read(spark, path):
    return spark.read.schema(schemas.SILVER).parquet(path)


def test_customers_equal_the_full_computation(spark, silver):
    states, accounts = new_path(spark, "days"), new_path(spark, "accounts")
    rollups.refresh(read(spark, silver), states, rollups.customer_days)
    rollups.refresh(read(spark, silver), accounts, rollups.customer_day_accounts)
    merged = rollups.core_from_days(
        rollups.read_states(spark, states, rollups.CUSTOMER_DAYS),
        rollups.read_states(spark, accounts, rollups.CUSTOMER_DAY_ACCOUNTS), "2024-02-05", 40)
    recent = read(spark, silver).filter("status != 'failed'")
    full = customers.customer_core_agg(recent, "2024-02-05", 40).select(merged.columns)
    same = [c for c in merged.columns if c != "p95_transaction_value"]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(merged.select(same)) == rows(full.select(same)) and full.count() == 18
    assert merged.dtypes == full.dtypes
    # The sketch: exact for the small customers, within its rank error for the hot one.
    for r in merged.collect():
        own = sorted(x["amount"] for x in recent.filter(F.col("customer_id") == r["customer_id"]).collect())
        low, high = (own[max(0, min(len(own) - 1, int((0.95 + e) * len(own))))] for e in (-0.02, 0.02))
        assert low <= r["p95_transaction_value"] <= high


def test_a_changed_day_rewrites_one_day(spark, silver):
    states = new_path(spark, "days")
    assert len(rollups.refresh(read(spark, silver), states, rollups.customer_days)) == 3
    files = lambda: set(tables.data_files(rollups.read_states(spark, states, rollups.CUSTOMER_DAYS)))
    before = files()
    assert rollups.refresh(read(spark, silver), states, rollups.customer_days) == [] and files() == before
    tables.append(varied(spark, DAYS[1], 5), silver, "event_date")
    assert [str(d) for d in rollups.refresh(read(spark, silver), states, rollups.customer_days)] == [DAYS[1]]
    assert {f for f in files() ^ before} == {f for f in files() | before if DAYS[1] in f}
    tables.replace_partition(varied(spark, DAYS[2]).limit(0), silver, "event_date", [DAYS[2]])
    rollups.refresh(read(spark, silver), states, rollups.customer_days)
    days = rollups.read_states(spark, states, rollups.CUSTOMER_DAYS).select("event_date").distinct().collect()
    assert sorted(str(r[0]) for r in days) == DAYS[:2]


def test_quantiles_of_many_days_within_the_rank_error(spark):
    path, states = new_path(spark, "silver"), new_path(spark, "amounts")
    x = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    known = {
        "transaction_id": F.col("id").cast("string"), "amount": x / 100, "currency": F.lit("USD"),
        "transaction_type": F.lit("purchase"), "event_date": F.date_add(F.lit("2024-01-01"), (F.col("id") % 20).cast("int"))}
    shaped = spark.range(60_000).select(*(
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in T.StructType.fromDDL(schemas.SILVER).fields))
    tables.append(shaped, path, "event_date")
    rollups.refresh(read(spark, path), states, rollups.amount_days)
    got = rollups.amounts_over(rollups.read_states(spark, states, rollups.AMOUNT_DAYS), ["currency"]).first()
    own = sorted(r[0] for r in shaped.select("amount").collect())
    assert got["tx_count"] == 60_000 and got["total_volume"] == sum(own)
    for name, share in rollups.QUANTILES.items():
        low, high = (own[int(min(0.9999, share + e) * len(own))] for e in (-0.002, 0.002))
        assert low <= got[name] <= high


def test_distinct_merchants_from_bitmaps(spark, silver):
    ids, states = new_path(spark, "ids"), new_path(spark, "merchants")

    def follow():
        known = rollups.add_merchant_ids(read(spark, silver), ids)
        rollups.refresh(read(spark, silver), states, lambda days: rollups.merchant_days(days, known))
        return known

    first = {r["merchant"]: r["id"] for r in follow().collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    new = varied(spark, DAYS[0], 40).withColumn("merchant", F.concat(F.lit("new"), F.col("transaction_id")))
    tables.append(new, silver, "event_date")
    second = {r["merchant"]: r["id"] for r in follow().collect()}
    assert first.items() < second.items() and sorted(second.values()) == list(range(1, len(second) + 1))
    month = F.trunc("event_date", "month").alias("month")
    got = rollups.merchants_over(
        rollups.read_states(spark, states, rollups.MERCHANT_DAYS), [month, "merchant_category"])
    want = read(spark, silver).groupBy(month, "merchant_category").agg(F.count_distinct("merchant").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

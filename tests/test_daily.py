"""A day of the lake from messages to gold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermill import jobs, schemas
from ledgermill.operators import tables
from ledgermill.plans import reports, star
from ledgermill.plans.daily import Lake, run_day
from ledgermill.sources import ledger, transport

FOLDER = "/root/testdata/sf0.001"
DAY = "2024-01-30"


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    messages = ledger.messages(ledger.read_table(spark, FOLDER, "events"))
    bronze = transport.bronze_project(messages, F.col("timestamp"))
    bronze.write.partitionBy("ingestion_date").parquet(lake.bronze)
    ledger.customers(spark, FOLDER).write.parquet(lake.customers)
    return lake


def contents(spark, path, *dropped):
    return sorted(map(str, spark.read.parquet(path).drop(*dropped).collect()))


def test_day_runs_twice_to_the_same_tables(spark, lake):
    for day in ("2024-01-29", DAY):
        first = run_day(spark, lake, day, as_of=f"{day} 23:59:59")
    assert first["gate_passed"] in (True, False)
    silver, quarantine = contents(spark, lake.silver), spark.read.parquet(lake.quarantine).count()
    again = run_day(spark, lake, DAY, as_of=f"{DAY} 23:59:59")
    assert again["insert"] == again["update"] == 0
    assert contents(spark, lake.silver) == silver
    assert spark.read.parquet(lake.quarantine).count() == quarantine
    ids = spark.read.parquet(lake.silver).select("transaction_id")
    assert ids.count() == ids.distinct().count()


def test_shut_gate_stops_before_gold(spark, lake):
    result = run_day(spark, lake, DAY, as_of="2024-02-05")  # stale
    assert result["gate_passed"] is False
    assert not tables.table_exists(spark, lake.gold("customer_analytics"))


LENIENT = {
    "validity_currency_known": 0.5, "validity_amount_positive": 0.5, "late_arrival_rate": 0.0,
    "referential_integrity_customer": 0.5,
}


def test_open_gate_builds_gold(spark, lake):
    last = "2024-01-30 23:59:59"
    assert run_day(spark, lake, DAY, as_of=last, thresholds=LENIENT)["gate_passed"]
    gold = spark.read.parquet(lake.gold("customer_analytics"))
    top = reports.top_customers(gold, DAY)
    assert 0 < top.count() <= 10
    assert "activity_tier" in gold.columns and "processed_at" in gold.columns
    for name in ("transaction_analytics", "risk_metrics", "risk_signals"):
        assert spark.read.parquet(lake.gold(name)).count() > 0


def test_past_day_by_command_line(spark, lake, capsys):
    """The moment of checking is the day's end, and the exit status is the gate's."""
    strict = ["--lake", lake.base, "day", "--process-date", DAY]
    assert jobs.run(spark, strict) == 1
    assert not tables.table_exists(spark, lake.gold("customer_analytics"))
    lenient = [f"--threshold={name}={rate}" for name, rate in LENIENT.items()]
    assert jobs.run(spark, [*strict, *lenient, "--as-of", f"{DAY} 23:59:59"]) == 0
    assert tables.table_exists(spark, lake.gold("customer_analytics"))
    assert jobs.run(spark, ["--lake", lake.base, "check", "--process-date", DAY]) == 1
    assert jobs.run(spark, ["--lake", lake.base, "freshness", "--as-of", "2030-01-01"]) == 1


def test_a_day_without_signals_any_more_loses_the_old_ones(spark, lake):
    run_day(spark, lake, DAY, as_of=f"{DAY} 23:59:59", thresholds=LENIENT)
    path = lake.gold("risk_signals")
    assert spark.read.parquet(path).filter(F.col("process_date") == DAY).count() > 0
    none = spark.read.parquet(path).limit(0)
    tables.replace_partition(none, path, "process_date", [DAY])
    assert not tables.table_exists(spark, f"{path}/process_date={DAY}")


def test_trends_end_with_the_day(spark):
    days = [dt.date(2024, 1, d) for d in (1, 10, 15, 30)]
    gold = spark.createDataFrame([(d, "loyal", 1) for d in days],
                                 "process_date date, activity_tier string, customer_id int")
    gold = gold.withColumn("total_spend", F.lit(1).cast("decimal(28,2)"))
    found = reports.activity_trend(gold, "2024-01-15", 7).collect()
    assert [r["process_date"].day for r in found] == [10, 15]


def test_no_two_merchants_share_a_key(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), ("a", None), ("a", ""), ("", "a"), ('a"', "b"), ("a", '"b')]
    found = star.dim_merchant(spark.createDataFrame(pairs, "merchant string, merchant_category string"))
    assert found.select("merchant_key").distinct().count() == len(pairs)


def test_day_without_messages(spark, lake):
    result = run_day(spark, lake, "2030-01-01")
    assert result["gate_passed"] is True


def test_products_have_the_entity_schema(spark):
    products = ledger.products(spark, FOLDER)
    wanted = spark.createDataFrame([], schemas.PRODUCTS)
    assert dict(products.dtypes) == dict(wanted.dtypes)
    assert star.dim_product(products).count() == products.count() > 0


def test_gold_from_states_equals_gold_from_the_ledger(spark, lake):
    run_day(spark, lake, DAY, as_of=f"{DAY} 23:59:59", thresholds=LENIENT)
    plain = contents(spark, lake.gold("customer_analytics"), "processed_at")
    for buckets in (None, None, 3):
        run_day(spark, lake, DAY, as_of=f"{DAY} 23:59:59", thresholds=LENIENT, from_states=True, buckets=buckets)
        assert contents(spark, lake.gold("customer_analytics"), "processed_at") == plain

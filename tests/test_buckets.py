"""Bucketed tables: rows, plans without exchanges, replaced partitions, refused layouts."""

import re

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import tables
from ledgermill.operators.buckets import Buckets, read_buckets, replace_buckets
from ledgermill.plans import rollups
from ledgermill.workspace import new_path
from silver_rows import silver_rows

SCHEMA = "day date, k string, n bigint"
BY_K = Buckets(("k",), 6)
DAYS = ["2024-01-10", "2024-01-11", "2024-02-02"]


def days_of(spark, *rows):
    return spark.createDataFrame(rows, "day string, k string, n bigint").withColumn("day", F.to_date("day"))


def contents(df):
    return sorted(map(str, df.select("day", "k", "n").collect()))


def exchanges(df):
    """Hash exchanges of the executed plan's first form, by their columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def but_sketches(df):
    """Rows without the quantile, which depends on the order of merging within its error."""
    return sorted(map(str, df.drop("p95_transaction_value").collect()))


@pytest.fixture
def table(spark):
    path = new_path(spark, "bucketed")
    rows = [(d, f"k{i % 40}" if i % 7 else None, i) for d in DAYS[:2] for i in range(200)]
    replace_buckets(days_of(spark, *rows), path, SCHEMA, "day", BY_K)
    return path


def test_rows_come_back_and_partitions_have_a_file_a_bucket(spark, table):
    rows = [(d, f"k{i % 40}" if i % 7 else None, i) for d in DAYS[:2] for i in range(200)]
    found = read_buckets(spark, table, SCHEMA, "day", BY_K)
    assert contents(found) == contents(days_of(spark, *rows))
    assert len(tables.data_files(found.filter(F.col("day") == DAYS[0]))) == 6


def test_no_exchange_for_groups_and_joins_on_the_bucket_column(spark, table):
    other = new_path(spark, "bucketed")
    replace_buckets(days_of(spark, *[(DAYS[0], f"k{i}", i) for i in range(60)]), other, SCHEMA, "day", BY_K)
    left = read_buckets(spark, table, SCHEMA, "day", BY_K).groupBy("k").agg(F.sum("n").alias("n"))
    right = read_buckets(spark, other, SCHEMA, "day", BY_K).groupBy("k").agg(F.max("n").alias("m"))
    joined = left.join(right.hint("merge"), "k")
    assert exchanges(joined) == []
    assert joined.count() == 40
    assert exchanges(spark.read.parquet(table).groupBy("k").count()) == ["k"]


def test_replaced_and_emptied_days(spark, table):
    new = [(DAYS[1], "x", 1), (DAYS[2], "y", 2)]
    replace_buckets(days_of(spark, *new), table, SCHEMA, "day", BY_K, DAYS)
    replace_buckets(days_of(spark, *new), table, SCHEMA, "day", BY_K, DAYS)
    found = read_buckets(spark, table, SCHEMA, "day", BY_K)
    assert contents(found) == contents(days_of(spark, *new))
    assert contents(found.filter(F.col("day") == DAYS[0])) == []


def test_an_empty_frame_makes_an_empty_table(spark):
    path = new_path(spark, "bucketed")
    replace_buckets(days_of(spark), path, SCHEMA, "day", BY_K)
    assert read_buckets(spark, path, SCHEMA, "day", BY_K).count() == 0


def test_a_later_session_finds_the_table(spark, table):
    later = spark.newSession()
    later.sql("DROP TABLE " + read_buckets(spark, table, SCHEMA, "day", BY_K)
              ._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().table())
    found = read_buckets(later, table, SCHEMA, "day", BY_K)
    assert found.count() == 400 and exchanges(found.groupBy("k").count()) == []


def test_other_buckets_than_the_noted_ones_are_refused(spark, table):
    for other in (Buckets(("k",), 5), Buckets(("n",), 6)):
        with pytest.raises(ValueError, match="not"):
            read_buckets(spark, table, SCHEMA, "day", other)
    plain = new_path(spark, "plain")
    tables.append(days_of(spark, (DAYS[0], "k", 1)), plain, "day")
    with pytest.raises(ValueError, match="not buckets"):
        read_buckets(spark, plain, SCHEMA, "day", BY_K)


def test_customers_from_buckets_shuffle_no_states(spark):
    path = new_path(spark, "silver")
    for d in DAYS:
        x = F.pmod(F.xxhash64("transaction_id", F.lit(d)), F.lit(1000))
        hot = F.when(x % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (x % 17).cast("string")))
        tables.append(silver_rows(spark, range(300), day=d).withColumns({
            "customer_id": hot, "account_id": F.when(x % 5 > 0, F.concat(hot, (x % 40).cast("string"))),
            "amount": x.cast("decimal(18,2)")}), path, "event_date")
    silver = spark.read.schema(spark.read.parquet(path).schema).parquet(path)
    frames = {}
    for buckets in (None, 5):
        days, accounts = new_path(spark, "days"), new_path(spark, "accounts")
        assert len(rollups.refresh_customers(silver, days, accounts, buckets)) == 3
        assert rollups.refresh_customers(silver, days, accounts, buckets) == []
        of_days, of_accounts = rollups.by_customer(buckets)
        frames[buckets] = rollups.core_from_days(
            rollups.read_states(spark, days, rollups.CUSTOMER_DAYS, of_days),
            rollups.read_states(spark, accounts, rollups.CUSTOMER_DAY_ACCOUNTS, of_accounts),
            "2024-02-05", 40)
    assert but_sketches(frames[5]) == but_sketches(frames[None]) and frames[5].count() == 18
    # Only one exchange is left: sums of accounts per customer and bucket, a row each.
    assert exchanges(frames[5]) == ["customer_id"]
    assert len(exchanges(frames[None])) > 1

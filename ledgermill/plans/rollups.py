"""Gold from daily states that add up, instead of from the ledger.

Each event day has small mergeable states: sums, quantile sketches and bitmaps per group. A
snapshot over 91 days, a week or a month merges its days' states; a day is worked out again only
when silver's files of that day are others than those it was worked out from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgermill.functions.measures import mean_from, quantiles_of_counts, rows, total
from ledgermill.functions.times import day
from ledgermill.operators.buckets import Buckets, read_buckets, replace_buckets
from ledgermill.operators.sequence import numbered
from ledgermill.operators.tables import append, replace_partition, table_exists
from ledgermill.plans.customers import snapshot
from ledgermill.plans.transactions import QUANTILES
from ledgermill.sources.scans import CUSTOMER_LOOKBACK, not_failed, scan_lookback
from ledgermill.workspace import stage

#: Size of the quantile sketches of a customer's day and of a group's day: up to so many amounts
#: they are exact, beyond their rank error is below 1.7 % and 0.1 %.
CUSTOMER_K, GROUP_K = 200, 4096
SOURCES = "_sources"
_MARKS = "event_date date, source string"

Build = Callable[[DataFrame], DataFrame]


def source_marks(silver: DataFrame) -> DataFrame:
    """For every day a digest of the names of its files; no data is read."""
    files = silver.select("event_date", F.col("_metadata.file_path").alias("file")).distinct()
    return files.filter(F.col("event_date").isNotNull()).groupBy("event_date").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("file")), "|"), 256).alias("source"))


def refresh(
    silver: DataFrame, path: str, build: Build, schema: T.StructType | str | None = None,
    buckets: Buckets | None = None,
) -> list[dt.date]:
    """Bring a table of daily states up to date with silver; the days that were worked out again.

    ``silver`` is a stored table partitioned by day and ``build`` maps rows of some days to their
    states. Days whose files changed are replaced, days that are gone go, the rest is not read.
    What the states were made from is noted last: after an interruption days are redone. With
    ``buckets`` the table, of the given schema, is bucketed.
    """
    spark = silver.sparkSession
    noted = f"{path}/{SOURCES}"
    now = stage(source_marks(silver), "marks")
    before = (spark.read.schema(_MARKS).parquet(noted) if table_exists(spark, noted)
              else spark.createDataFrame([], _MARKS)).withColumnRenamed("source", "was")
    changed = now.join(before, "event_date", "full_outer").filter(~F.col("source").eqNullSafe(F.col("was")))
    days = sorted(r[0] for r in changed.select("event_date").collect())  # as many as silver has days
    if days:
        states = build(silver.filter(F.col("event_date").isin(days)))
        if buckets:
            replace_buckets(states, path, schema, "event_date", buckets, days)
        else:
            replace_partition(states.hint("rebalance", "event_date"), path, "event_date", days)
        now.coalesce(1).write.mode("overwrite").parquet(noted)
    return days


def read_states(
    spark: SparkSession, path: str, schema: T.StructType | str, buckets: Buckets | None = None
) -> DataFrame:
    if buckets:
        return read_buckets(spark, path, schema, "event_date", buckets)
    return spark.read.schema(schema).parquet(path)


def cents(amount: str = "amount") -> Column:
    return (F.col(amount) * 100).cast("bigint")


def quantile(sketch: str, share: float) -> Column:
    return (F.kll_sketch_get_quantile_bigint(sketch, F.lit(share)).cast("decimal(20,0)") / 100).cast("decimal(18,2)")


# --- customers ---

CUSTOMER_DAYS = (
    "event_date date, customer_id string, tx bigint, spend decimal(28,2), first_at timestamp, "
    "last_at timestamp, purchases decimal(28,2), transfers decimal(28,2), sketch binary")
CUSTOMER_DAY_ACCOUNTS = "event_date date, customer_id string, account_id string"


def by_customer(count: int | None) -> tuple[Buckets | None, Buckets | None]:
    """Buckets of the customers' days and of their days' accounts; None for plain tables.

    A customer has one row a day in the first. In the second a customer may have any number, so
    the account is part of the bucket: distinct accounts need no exchange, and what is summed per
    customer after that is one number for each bucket.
    """
    if not count:
        return None, None
    return Buckets(("customer_id",), count), Buckets(("customer_id", "account_id"), count)


def customer_days(silver: DataFrame) -> DataFrame:
    """One row per day and customer; failed transactions don't count."""
    kind = F.col("transaction_type")
    return not_failed(silver).groupBy("event_date", "customer_id").agg(
        rows().alias("tx"), total("amount").alias("spend"),
        F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"),
        total("amount", kind == "purchase").alias("purchases"),
        total("amount", kind == "transfer").alias("transfers"),
        F.kll_sketch_agg_bigint(cents(), F.lit(CUSTOMER_K)).alias("sketch"))


def customer_day_accounts(silver: DataFrame) -> DataFrame:
    """The accounts that a customer used on a day, a row each, as they may be many."""
    return not_failed(silver).select("event_date", "customer_id", "account_id").distinct()


def refresh_customers(
    silver: DataFrame, states: str, accounts: str, buckets: int | None = None
) -> list[dt.date]:
    """Both tables of customers' days brought up to date; the days that were worked out again."""
    of_days, of_accounts = by_customer(buckets)
    days = refresh(silver, states, customer_days, CUSTOMER_DAYS, of_days)
    return sorted({*days, *refresh(
        silver, accounts, customer_day_accounts, CUSTOMER_DAY_ACCOUNTS, of_accounts)})


def core_from_days(
    days: DataFrame, accounts: DataFrame, process_date: str | dt.date,
    lookback: int = CUSTOMER_LOOKBACK,
) -> DataFrame:
    """``customer_core_agg`` from the states of the lookback's days; a day has one row a customer,
    so active days are rows. Only the quantile may differ, by the sketch's rank error."""
    merged = scan_lookback(days, process_date, lookback).groupBy("customer_id").agg(
        F.sum("tx").alias("total_transactions"),
        F.sum("spend").cast("decimal(28,2)").alias("total_spend"),
        F.max("last_at").alias("last_transaction_at"),
        F.min("first_at").alias("first_transaction_at"),
        F.max("event_date").alias("last_event_date"), rows().alias("active_days"),
        F.sum("purchases").cast("decimal(28,2)").alias("total_purchases"),
        F.sum("transfers").cast("decimal(28,2)").alias("total_transfers"),
        F.kll_merge_agg_bigint("sketch", F.lit(CUSTOMER_K)).alias("sketch"))
    used = scan_lookback(accounts, process_date, lookback).groupBy("customer_id").agg(
        F.count_distinct("account_id").alias("accounts_used"))
    return merged.join(used, "customer_id").select(
        "customer_id", "total_transactions", "total_spend",
        mean_from(F.col("total_spend"), F.col("total_transactions")).alias("avg_transaction_value"),
        "last_transaction_at", "first_transaction_at", "last_event_date", "active_days",
        "accounts_used", "total_purchases", "total_transfers",
        quantile("sketch", 0.95).alias("p95_transaction_value"))


def gold_customers_from_days(
    spark: SparkSession, states: str, accounts: str, customers: DataFrame,
    process_date: str | dt.date, buckets: int | None = None,
) -> DataFrame:
    """The customer snapshot of one day from stored daily states, in ``buckets`` where given."""
    of_days, of_accounts = by_customer(buckets)
    core = core_from_days(read_states(spark, states, CUSTOMER_DAYS, of_days),
                          read_states(spark, accounts, CUSTOMER_DAY_ACCOUNTS, of_accounts), process_date)
    return snapshot(stage(core, "customer-core"), customers, process_date)


# --- amounts by type and currency ---

AMOUNT_DAYS = (
    "event_date date, transaction_type string, currency string, tx_count bigint, "
    "total_volume decimal(28,2), sketch binary")


def amount_days(silver: DataFrame) -> DataFrame:
    """Per day, type and currency: count, sum and quantile sketch of the amounts."""
    return silver.groupBy("event_date", "transaction_type", "currency").agg(
        rows().alias("tx_count"), total("amount").alias("total_volume"),
        F.kll_sketch_agg_bigint(cents(), F.lit(GROUP_K)).alias("sketch"))


def amounts_over(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Count, sum and quantiles of any groups of days, types and currencies, from their sketches."""
    merged = states.groupBy(*keys).agg(
        F.sum("tx_count").alias("tx_count"),
        F.sum("total_volume").cast("decimal(28,2)").alias("total_volume"),
        F.kll_merge_agg_bigint("sketch", F.lit(GROUP_K)).alias("sketch"))
    return merged.select(
        *(c for c in merged.columns if c != "sketch"),
        *(quantile("sketch", share).alias(name) for name, share in QUANTILES.items()))


#: The exact form of the same states: how often an amount occurs, a row per amount.
AMOUNT_COUNTS = (
    "event_date date, transaction_type string, currency string, amount decimal(18,2), n bigint")


def amount_counts(silver: DataFrame) -> DataFrame:
    """Per day, type and currency: every amount and how often it occurs."""
    return silver.groupBy("event_date", "transaction_type", "currency", "amount").agg(rows().alias("n"))


def amounts_exactly(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Count, sum and exact quantiles of any groups of days, types and currencies, from the counts."""
    merged = states.groupBy(*keys, "amount").agg(F.sum("n").alias("n"))
    return quantiles_of_counts(
        merged, [c for c in merged.columns if c not in ("amount", "n")], QUANTILES,
        [F.sum("n").alias("tx_count"), total(F.col("amount") * F.col("n")).alias("total_volume")])


# --- merchants ---

MERCHANT_IDS = "merchant string, id bigint"
MERCHANT_DAYS = "event_date date, merchant_category string, bucket bigint, bitmap binary"


def add_merchant_ids(silver: DataFrame, path: str) -> DataFrame:
    """Dense ids of all merchants; new ones get the numbers after those that are given out."""
    spark = silver.sparkSession
    seen = silver.filter(F.col("merchant").isNotNull()).select("merchant").distinct()
    known = (spark.read.schema(MERCHANT_IDS).parquet(path) if table_exists(spark, path)
             else spark.createDataFrame([], MERCHANT_IDS))
    last = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = stage(seen.join(known, "merchant", "left_anti"), "new-merchants")
    if not new.isEmpty():
        placed = numbered(new.withColumn("all", F.lit(1)), "all", ["merchant"], "id")
        append(placed.select("merchant", (F.col("id") + last).alias("id")), path)
        spark.catalog.refreshByPath(path)
    return spark.read.schema(MERCHANT_IDS).parquet(path)


def merchant_days(silver: DataFrame, ids: DataFrame) -> DataFrame:
    """Per day and category the set of merchants: a bitmap for every 32 768 ids."""
    seen = silver.select("event_date", "merchant_category", "merchant").distinct().join(ids, "merchant")
    return seen.groupBy(
        "event_date", "merchant_category", F.bitmap_bucket_number("id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def merchants_over(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Distinct merchants of any groups of days and categories; exact, where daily counts don't add up."""
    sets = states.withColumns({f"_key{k}": F.col(c) if isinstance(c, str) else c for k, c in enumerate(keys)})
    names = [f"_key{k}" for k in range(len(keys))]
    joined = sets.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    found = joined.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_merchants"))
    labels = states.select(*(F.col(c) if isinstance(c, str) else c for c in keys)).columns
    return found.select(*(F.col(n).alias(x) for n, x in zip(names, labels)), "unique_merchants")

"""Ledger tables derived from the star-schema and event tables of a data folder.

Every event becomes a message with a JSON transaction, some of them untidy on purpose: padded
or upper-case text, negative and zero amounts, unknown codes, missing and unknown customers,
payloads that are no JSON, and a second delivery of some ids a little later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgermill import schemas
from ledgermill.functions.text import pick

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _code(prefix: str, number: Column) -> Column:
    return F.format_string(f"{prefix}%08d", number)


def _every(step: int, at: int) -> Column:
    return F.col("event_id") % step == at


def messages(events: DataFrame) -> DataFrame:
    """Transport rows (key, value, topic, partition, offset, timestamp) of an event frame.

    A stateless projection, so it serves batch and streaming alike; the second delivery of an
    event is exploded from the row itself.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    deliveries = F.when(_every(50, 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.select(
        "*", k.alias("k"), F.explode(deliveries).alias("delivery"),
        (F.col("event_id") % 3 == 0).alias("v3"),
    )

    amount = F.col("value").cast("decimal(18,2)")
    amount = F.when(_every(300, 19), F.lit(0)).when(_every(20, 13), -amount).otherwise(amount)
    currency = pick(schemas.CURRENCIES, F.col("k") % 7)
    currency = F.when(_every(200, 11), F.lit("XXX")).when(
        _every(4, 1), F.concat(F.lit(" "), F.lower(currency), F.lit(" "))).otherwise(currency)
    kind = pick(schemas.TRANSACTION_TYPES, F.col("k") % 5)
    kind = F.when(_every(5, 2), F.concat(F.lit(" "), F.upper(kind))).otherwise(kind)
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("k") % 10 == 0, "pending")
        .otherwise("completed")
    )
    status = (
        F.when(F.col("delivery") == 1, "completed")
        .when(_every(250, 17), "reversed")
        .when(_every(6, 1), F.upper(status))
        .otherwise(status)
    )

    def padded(text: Column) -> Column:
        return F.when(_every(40, 3), F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text)

    account = padded(_code("ACC", F.col("user_id") * 2 + (
        F.col("event_type") == "purchase").cast("bigint")))
    # Some customers are unknown to the dimension.
    stranger = F.when(_every(90, 31), 50_000_000).otherwise(0)
    payload = F.struct(
        padded(_code("TXN", F.col("event_id"))).alias("transaction_id"),
        account.alias("account_id"),
        F.when(~_every(100, 7), _code("CUS", F.col("user_id") + stranger)).alias("customer_id"),
        kind.alias("transaction_type"),
        amount.cast("decimal(18,2)").alias("amount"),
        currency.alias("currency"),
        F.concat(F.lit("M"), F.col("k")).alias("merchant"),
        pick(schemas.MERCHANT_CATEGORIES, F.col("k") % 8).alias("merchant_category"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        status.alias("status"),
        F.when(~_every(10, 0), pick(schemas.PAYMENT_METHODS, F.col("k") % 5))
        .alias("payment_method"),
        F.when(F.col("v3"), _code("DEV", F.col("user_id"))).alias("device_fingerprint"),
        F.when(F.col("v3"), F.concat(F.lit("NATION_"), F.col("k") % 25)).alias("ip_country"),
        (F.col("k") % 40 >= 10).alias("_is_late_arrival"),
    )
    value = F.when(
        _every(500, 499), F.concat(F.lit("corrupt:"), F.col("event_id"))
    ).otherwise(F.to_json(payload))
    minutes = F.col("k") % 40 + F.col("delivery") * 5
    arrival = F.col("ts").cast("timestamp") + F.make_dt_interval(mins=minutes)
    return rows.select(
        account.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(schemas.TOPIC).alias("topic"),
        (F.col("user_id") % schemas.TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("delivery")).alias("offset"),
        arrival.alias("timestamp"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    created = F.lit("2019-01-01").cast("date")
    opened = F.date_add(created, (key % 1800).cast("int"))
    return (
        read_table(spark, folder, "customer")
        .join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _code("CUS", key).alias("customer_id"),
            F.col("c_name").alias("name"),
            (key % 63 + 18).cast("int").alias("age"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
            F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                     F.lit("@example.com")).alias("email"),
            F.format_string("+1-%010d", key).alias("phone"),
            pick(schemas.CURRENCIES[:4], key % 4).alias("preferred_currency"),
            opened.cast("timestamp").alias("created_at"),
            F.date_add(opened, (key % 365).cast("int")).cast("timestamp").alias("updated_at"),
        )
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Two accounts per customer, the ids the messages refer to."""
    key = F.col("c_custkey")
    created = F.date_add(F.lit("2019-01-01").cast("date"), (key % 1800).cast("int"))
    return (
        read_table(spark, folder, "customer")
        .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("nth"))
        .select(
            _code("ACC", key * 2 + F.col("nth")).alias("account_id"),
            _code("CUS", key).alias("customer_id"),
            pick(schemas.ACCOUNT_TYPES, (key + F.col("nth")) % 4).alias("account_type"),
            F.when(key % 20 == 0, "blocked").when(key % 10 == 1, "inactive")
            .otherwise("active").alias("status"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
            pick(schemas.CURRENCIES[:4], key % 4).alias("currency"),
            created.cast("timestamp").alias("created_at"),
            created.cast("timestamp").alias("updated_at"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """A product per part: its number, name, type of account, a rate and a least balance."""
    key = F.col("p_partkey")
    created = F.date_add(F.lit("2015-01-01").cast("date"), (key % 2000).cast("int"))
    return read_table(spark, folder, "part").select(
        _code("PRD", key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        pick(schemas.ACCOUNT_TYPES, key % 4).alias("category"),
        (F.col("p_size") / 4.0).alias("interest_rate"),
        F.when(key % 10 == 0, "discontinued").otherwise("active").alias("status"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("minimum_balance"),
        created.cast("timestamp").alias("created_at"),
        F.date_add(created, (key % 730).cast("int")).cast("timestamp").alias("updated_at"),
    )

"""Streaming jobs from messages to bronze, silver and incremental aggregates.

State lives in RocksDB, so it may outgrow an executor's heap. Every job takes the stream it
works on; ``run_available`` drives a query over all input that is there and returns.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgermill import schemas
from ledgermill.functions.measures import MONEY, rows, total
from ledgermill.operators import clean
from ledgermill.operators.dedup import dedup_latest
from ledgermill.operators.tables import finish_swaps, table_exists
from ledgermill.operators.upsert import likely_rows, newer, upsert_table, upsert_transactions
from ledgermill.plans import profile
from ledgermill.session import ROCKSDB
from ledgermill.streaming import additive
from ledgermill.workspace import scratch, stage

# Event-time slack and default trigger.
WATERMARK = "30 minutes"
TRIGGER = "1 minute"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a query copies when it starts: RocksDB state in ``partitions`` pieces.

    The number of pieces is fixed for the life of a checkpoint; the default is one per core of
    the cluster.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def start(
    spark: SparkSession, writer: DataStreamWriter, path: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    with state_settings(spark, state_partitions):
        return writer.start(path) if path else writer.start()


def run_available(
    spark: SparkSession, writer: DataStreamWriter, path: str | None = None,
    state_partitions: int | None = None,
) -> None:
    """Process everything available, then stop."""
    start(spark, writer.trigger(availableNow=True), path, state_partitions).awaitTermination()


def parquet_sink(
    stream: DataFrame, checkpoint: str, partition_by: str | None = None
) -> DataStreamWriter:
    """Append-only files, written exactly once by way of the checkpoint."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(partition_by) if partition_by else writer


def bronze_sink(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    return parquet_sink(stream, checkpoint, "ingestion_date")


def start_bronze(
    stream: DataFrame, path: str, checkpoint: str, every: str = TRIGGER
) -> StreamingQuery:
    """Start the long-running ingestion and return its query."""
    writer = bronze_sink(stream, checkpoint).trigger(processingTime=every)
    return start(stream.sparkSession, writer, path)


def cleaned(bronze: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The cleaning step with event time declared."""
    return clean.clean_transactions(bronze).withWatermark("timestamp", delay)


def deduplicated(transactions: DataFrame) -> DataFrame:
    """Drop repeated deliveries that arrive within the watermark; state expires with it.

    Copies further apart pass, and rows later than the watermark are left out by Spark without a
    trace: where every id must arrive, use ``first_deliveries_sink``, which has no watermark, or
    take the late rows from ``late_split_sink``.
    """
    return transactions.dropDuplicatesWithinWatermark(["transaction_id"])


def late_split_sink(transactions: DataFrame, checkpoint: str) -> DataStreamWriter:
    """On-time and late rows in separate partitions; nothing is dropped."""
    return parquet_sink(transactions, checkpoint, "is_late_arrival")


def hourly_volume(transactions: DataFrame) -> DataFrame:
    """Volume per closed hour and type.

    An hour is final once the watermark has passed it. Rows later than that are in the late
    partition of ``late_split_sink``; ``hourly_sink`` counts them, too.
    """
    hour = F.window("timestamp", "1 hour").alias("window")
    return (
        transactions.groupBy(hour, "transaction_type")
        .agg(rows().alias("tx_count"), total("amount").alias("total_volume"))
        .select(F.col("window.start").alias("hour"), "transaction_type", "tx_count",
                "total_volume", F.to_date("window.start").alias("event_date"))
    )


def upsert_sink(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Clean, deduplicate and merge each micro-batch into silver.

    A batch that is repeated after a failure merges to the same table, since only strictly
    newer rows update.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        latest = dedup_latest(clean.clean_transactions(batch))
        upsert_transactions(batch.sparkSession, path, latest)

    return bronze.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def first_deliveries_sink(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Clean each micro-batch and add the ids that the table doesn't have yet.

    However late a row comes, it lands, and an id lands once: the table is the memory, not a state
    with a time limit. A repeated batch adds nothing.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        latest = dedup_latest(clean.clean_transactions(batch))
        upsert_table(
            batch.sparkSession, path, latest, ["transaction_id"], {}, F.lit(False),
            partition_by="event_date", schema=schemas.SILVER)

    return bronze.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


# Fixed shape of the hourly aggregate: its keys and what is added up.
HOURLY = f"hour timestamp, transaction_type string, tx_count bigint, total_volume {MONEY}"
HOURLY_KEYS, HOURLY_SUMS = ["hour", "transaction_type"], ["tx_count", "total_volume"]


def hourly_changes(spark: SparkSession, path: str, latest: DataFrame) -> DataFrame:
    """What merging a batch of latest deliveries into silver does to the volume per hour and type.

    A new id adds one transaction and its amount to its hour, however long that is past. A newer
    delivery of a known id adds the difference of the amounts to the hour where the id is.
    """
    hour = F.date_trunc("hour", "timestamp")
    one = latest.select(
        "transaction_id", "ingestion_timestamp", hour.alias("hour"), "transaction_type", "amount")
    change = one.withColumn("known", F.lit(False)).withColumn("before", F.lit(None).cast("decimal(18,2)"))
    if table_exists(spark, path):
        table = likely_rows(spark, path, latest, ["transaction_id"], schemas.SILVER)
        known = stage(table.alias("target").join(
            one.alias("source"), F.col("target.transaction_id") == F.col("source.transaction_id"))
            .select("source.transaction_id", F.coalesce(newer(), F.lit(False)).alias("updates"),
                    F.date_trunc("hour", "target.timestamp").alias("its_hour"),
                    F.col("target.transaction_type").alias("its_type"),
                    F.col("target.amount").alias("before")), "known-hours")
        joined = one.join(known, "transaction_id", "left")
        there = F.col("updates").isNotNull()
        change = joined.filter(F.coalesce("updates", F.lit(True))).select(
            F.when(there, F.col("its_hour")).otherwise(F.col("hour")).alias("hour"),
            F.when(there, F.col("its_type")).otherwise(F.col("transaction_type"))
            .alias("transaction_type"), "amount", there.alias("known"), "before")
    amount = F.col("amount") - F.when(F.col("known"), F.coalesce("before", F.lit(0))).otherwise(0)
    return change.groupBy(*HOURLY_KEYS).agg(
        F.sum(F.when(F.col("known"), 0).otherwise(1)).cast("bigint").alias("tx_count"),
        F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY).alias("total_volume"))


def merge_hourly(batch: DataFrame, number: int, silver: str, hourly: str) -> None:
    """One micro-batch into silver and the hourly volume; repeating it changes nothing.

    The batch's changes are written down before silver takes the batch: if they are there, they
    were worked out against silver as it was, and only the merge, which is idempotent, is left.
    """
    spark = batch.sparkSession
    with scratch(spark):
        latest = stage(dedup_latest(clean.clean_transactions(batch)), "latest")
        if not additive.counted(spark, hourly, number):
            finish_swaps(spark, silver)
            additive.add_batch(hourly_changes(spark, silver, latest), hourly, number)
        upsert_transactions(spark, silver, latest, staged=True)
        additive.fold(spark, hourly, HOURLY, HOURLY_KEYS, HOURLY_SUMS)


def hourly_sink(bronze: DataFrame, silver: str, hourly: str, checkpoint: str) -> DataStreamWriter:
    """Silver and the volume per hour, with late rows and updates as corrections of past hours.

    ``hourly_totals`` then equals the batch aggregate of silver after every trigger.
    """
    return bronze.writeStream.foreachBatch(
        lambda batch, number: merge_hourly(batch, number, silver, hourly)
    ).option("checkpointLocation", checkpoint)


def hourly_totals(spark: SparkSession, hourly: str) -> DataFrame:
    found = additive.totals(spark, hourly, HOURLY, HOURLY_KEYS, HOURLY_SUMS)
    return found.withColumn("event_date", F.to_date("hour"))


TALLY = "stat string, n bigint"


def tally_sink(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Running tallies of the messages: each micro-batch adds its own, once."""
    def add(batch: DataFrame, number: int) -> None:
        additive.add_batch(profile.tally(batch), path, number)
        additive.fold(batch.sparkSession, path, TALLY, ["stat"], ["n"])

    return bronze.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def tallies(spark: SparkSession, path: str) -> DataFrame:
    return additive.totals(spark, path, TALLY, ["stat"], ["n"])

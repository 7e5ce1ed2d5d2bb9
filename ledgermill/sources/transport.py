"""Message transport: stream sources, the bronze projection, the keyed JSON sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgermill import schemas
from ledgermill.operators.sequence import numbered, send_in_order


def kafka_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Source options. A trigger takes all there is unless ``max_offsets`` limits it, and messages
    that expired unread are an error unless their loss is accepted."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(
    spark: SparkSession, servers: str, topic: str = schemas.TOPIC, starting: str = "latest",
    max_offsets: int | None = None, fail_on_data_loss: bool = True,
) -> DataFrame:
    """Messages from a broker. Needs the Kafka connector on the class path."""
    options = kafka_options(servers, topic, starting, max_offsets, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str = schemas.TRANSPORT,
    files_per_trigger: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """The same messages from parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def bronze_project(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Messages as bronze rows: text key and payload, transport position, time of ingestion.

    ``ingested_at`` replaces the clock when an archive is replayed.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_payload"),
        *[F.col(c).alias(f"kafka_{c}") for c in ("topic", "partition", "offset", "timestamp")],
        now.alias("ingestion_timestamp"),
        now.cast("date").alias("ingestion_date"),
    )


def keyed_json(rows: DataFrame, key: str = "account_id") -> DataFrame:
    """Rows as key and JSON value. A key's messages go to one topic partition; ``ordered_json``
    numbers them and ``publish`` sends them in that order."""
    key_text = F.coalesce(F.col(key).cast("string"), F.lit("unknown"))
    return rows.select(
        key_text.alias("key"), F.to_json(F.struct(*rows.columns)).alias("value")
    )


def ordered_json(
    rows: DataFrame, order: Sequence[str] = ("timestamp", "transaction_id"), key: str = "account_id",
) -> DataFrame:
    """(key, seq, value): JSON messages with their places in their key's order of events.

    ``order`` ends in what tells rows apart.
    """
    held = rows.select(
        F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*rows.columns)).alias("value"),
        *(F.col(c).alias(f"_order_{c}") for c in order))
    return numbered(held, "key", [f"_order_{c}" for c in order]).select("key", "seq", "value")


def publish(
    rows: DataFrame, servers: str, topic: str = schemas.TOPIC,
    order: Sequence[str] = ("timestamp", "transaction_id"),
) -> None:
    """Send rows to a broker, each key's in the order of its events. Needs the Kafka connector."""
    send_in_order(ordered_json(rows, order), "key", "seq", lambda messages: (
        messages.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()))

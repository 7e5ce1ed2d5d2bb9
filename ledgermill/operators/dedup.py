"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order, which must be total within a key.

    Spark cuts each key to one row per task before the shuffle (WindowGroupLimit), so a key
    that holds a third of the rows sends one row per task and not all of them.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
    )


def dedup_latest(df: DataFrame) -> DataFrame:
    """The latest arrival of every transaction; transport position breaks ties."""
    newest = [F.desc(c) for c in ("ingestion_timestamp", "kafka_partition", "kafka_offset")]
    return keep_first(df, ["transaction_id"], newest)

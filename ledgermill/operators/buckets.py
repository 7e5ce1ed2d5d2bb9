"""Parquet tables whose files are hash buckets of some columns.

Aggregates and joins on the bucket columns read such a table without an exchange, as every task
gets whole buckets. A bucket is one task's work, so bucket by columns of which no value holds
many rows: sums per key and day, or a key together with what makes it many.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgermill.operators.tables import replace_partition, table_exists
from ledgermill.workspace import hadoop_path

NOTE = "_buckets.json"


@dataclass(frozen=True)
class Buckets:
    """Columns and number of a table's buckets; tables joined on them need the same number."""

    columns: tuple[str, ...]
    count: int


def _noted(spark: SparkSession, path: str) -> Buckets | None:
    jpath, fs = hadoop_path(spark, f"{path}/{NOTE}")
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    found = json.loads(text)
    return Buckets(tuple(found["columns"]), found["count"])


def _note(spark: SparkSession, path: str, buckets: Buckets) -> None:
    jpath, fs = hadoop_path(spark, f"{path}/{NOTE}")
    out = fs.create(jpath)
    out.write(bytearray(json.dumps({"columns": buckets.columns, "count": buckets.count}).encode()))
    out.close()


def attach(
    spark: SparkSession, path: str, schema: T.StructType | str, partition_by: str, buckets: Buckets
) -> str:
    """Make the folder a table of the session's catalog and return its name.

    Only the catalog knows that files are buckets, so each session attaches the folder anew. The
    folder notes its buckets, and other columns or another number than the noted ones are an
    error: rows would be looked for in the wrong files.
    """
    noted = _noted(spark, path)
    if noted is None and table_exists(spark, path):
        raise ValueError(f"{path} holds files that are not buckets")
    if noted is None:
        _note(spark, path, buckets)
    elif noted != buckets:
        raise ValueError(f"{path} has {noted}, not {buckets}")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    name = f"buckets_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    keys = ", ".join(f"`{c}`" for c in buckets.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (`{partition_by}`) "
        f"CLUSTERED BY ({keys}) INTO {buckets.count} BUCKETS LOCATION '{quoted}'")
    _sync(spark, name)
    return name


def _sync(spark: SparkSession, name: str) -> None:
    """The catalog's partitions are the folders that are there."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType | str, partition_by: str, buckets: Buckets
) -> DataFrame:
    """The table with its buckets; partition filters leave out folders, as usual."""
    return spark.table(attach(spark, path, schema, partition_by, buckets))


def replace_buckets(
    df: DataFrame, path: str, schema: T.StructType | str, partition_by: str, buckets: Buckets,
    values: Sequence | None = None,
) -> None:
    """``replace_partition`` for a bucketed table.

    Rows are dealt by the hash that numbers the buckets, so that a partition has one file a
    bucket. NULL in a bucket column is a value like any other.
    """
    spark = df.sparkSession
    name = attach(spark, path, schema, partition_by, buckets)
    dealt = df.select(*spark.table(name).columns).repartition(buckets.count, *buckets.columns)
    replace_partition(df, path, partition_by, values,
                      write=lambda: dealt.write.mode("overwrite").insertInto(name))
    _sync(spark, name)

"""Aggregates that grow by what each micro-batch adds.

A batch's sums are written once, in a folder named by the batch's number: a batch that is repeated
after a failure finds them there and adds nothing, so every batch counts once. A group's value is
the sum over the batches, however late its rows came; nothing is closed and no state expires.
Batches are folded into one base from time to time, so that readers sum few files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgermill.workspace import hadoop_path, remove

#: Batches after which the changes are folded into the base.
FOLD = 50


def _complete(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished folders of a kind, ascending."""
    jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    names = [e.getPath().getName() for e in fs.listStatus(jpath)]
    numbers = [int(m[1]) for n in names if (m := re.fullmatch(rf"{kind}=(\d+)", n))]
    return sorted(n for n in numbers if fs.exists(hadoop_path(spark, f"{path}/{kind}={n}/_SUCCESS")[0]))


def _parts(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """The base that counts, if any, and the batches after it."""
    base = _complete(spark, path, "base")[-1:]
    return base, [n for n in _complete(spark, path, "batch") if not base or n > base[0]]


def counted(spark: SparkSession, path: str, batch: int) -> bool:
    """Whether a batch is in the aggregate already."""
    base, batches = _parts(spark, path)
    return batch in batches or bool(base and batch <= base[0])


def add_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Add a batch's sums, unless they are there. One folder serves one checkpoint's batches."""
    spark = rows.sparkSession
    if counted(spark, path, batch):
        return
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def totals(
    spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str],
    sums: Sequence[str],
) -> DataFrame:
    """Sums over all batches; groups in which every sum is zero again are gone."""
    base, batches = _parts(spark, path)
    folders = [f"{path}/base={n}" for n in base] + [f"{path}/batch={n}" for n in batches]
    reader = spark.read.schema(schema)
    rows = reader.parquet(*folders) if folders else spark.createDataFrame([], schema)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    found = rows.groupBy(*keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in sums))
    some = F.lit(False)
    for c in sums:
        some = some | (F.col(c) != 0)
    return found.filter(some)


def fold(
    spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str],
    sums: Sequence[str], most: int = FOLD,
) -> None:
    """Write the sums so far as the new base where more than ``most`` batches lie beside the old.

    The old parts go once the base is finished; until then, and after an interruption, readers
    take the newest finished base and the batches behind it, so nothing counts twice.
    """
    base, batches = _parts(spark, path)
    if len(batches) <= most:
        return
    totals(spark, path, schema, keys, sums).hint("rebalance").write.mode("overwrite").parquet(
        f"{path}/base={batches[-1]}")
    for old in [f"{path}/base={n}" for n in base] + [f"{path}/batch={n}" for n in batches]:
        remove(spark, old)

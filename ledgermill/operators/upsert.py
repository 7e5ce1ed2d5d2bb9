"""Merge a batch into a keyed table: update newer, insert unknown, keep the rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgermill import schemas
from ledgermill.operators.keyfilters import (
    LITERALS, narrowed, pushed_literals, write_options,
)
from ledgermill.operators.tables import (
    append, data_files, finish_swaps, read_table, rewrite_table, table_exists,
)
from ledgermill.workspace import scratch, stage

# Columns a newer delivery of a transaction may change.
UPDATABLE = [
    "status", "amount", "payment_method", "device_fingerprint", "ip_country",
    "ingestion_timestamp", "is_late_arrival",
]


def source(column: str) -> Column:
    return F.col(f"source.{column}")


def target(column: str) -> Column:
    return F.col(f"target.{column}")


def newer() -> Column:
    """Strictly later arrival; a NULL time is never newer."""
    return source("ingestion_timestamp") > target("ingestion_timestamp")


def _match(keys: Sequence[str]) -> list[Column]:
    return [source(k) == target(k) for k in keys]


def _marked(df: DataFrame, side: str) -> DataFrame:
    return df.withColumn(f"_in_{side}", F.lit(True)).alias(side)


def _as_they_came(target_rows: DataFrame, source_rows: DataFrame) -> dict[str, Column]:
    """The batch's values of the table's columns; NULL where it has none."""
    return {c: source(c) if c in source_rows.columns else F.lit(None) for c in target_rows.columns}


ACTIONS = ("insert", "update", "duplicate", "untouched")


def _update_or_duplicate(condition: Column | None) -> Column:
    update = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    return F.when(update, "update").otherwise("duplicate")


def _action(condition: Column | None) -> Column:
    return F.when(F.col("_in_source").isNull(), "untouched").otherwise(
        _update_or_duplicate(condition))


def upsert(
    target_rows: DataFrame,
    source_rows: DataFrame,
    keys: Sequence[str],
    update_set: Mapping[str, Column],
    condition: Column | None = None,
    insert_values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The merged table as one frame, with what happened to each row in ``_action``.

    The batch is joined to the target, and the batch keys that the target lacks are added: no join
    needs the target on its outer side twice, so a small batch is broadcast and the target is not
    shuffled. The batch is read three times; stage it where computing it is dear.

    A ``duplicate`` is a batch row whose key is known and that doesn't update; an ``untouched`` row
    has no batch row. Expressions name the two sides ``source`` and ``target``. Source keys must be unique.
    """
    columns = target_rows.schema.fields
    joined = _marked(target_rows, "target").join(
        _marked(source_rows, "source"), _match(keys), "left").withColumn("_action", _action(condition))

    def value(name: str, kind) -> Column:
        if name not in update_set:
            return target(name)
        return F.when(F.col("_action") == "update", update_set[name]).otherwise(
            target(name)).cast(kind).alias(name)

    stored = joined.select(*(value(f.name, f.dataType) for f in columns), "_action")
    known = source_rows.alias("source").join(target_rows.alias("target"), _match(keys)).select(
        *(source(k) for k in keys))
    new = source_rows.join(known, list(keys), "left_anti")
    inserted = _inserted(target_rows, new, insert_values).withColumn("_action", F.lit("insert"))
    return stored.unionByName(inserted)


def upsert_latest(target_rows: DataFrame, source_rows: DataFrame) -> DataFrame:
    """The transaction merge: newer deliveries update, the partition column never moves."""
    return upsert(
        target_rows, source_rows, ["transaction_id"],
        {c: source(c) for c in UPDATABLE}, newer(),
    )


def upsert_metrics(merged: DataFrame) -> DataFrame:
    """Rows per action."""
    return merged.groupBy("_action").agg(F.count(F.lit(1)).alias("row_count"))


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    update_set: Mapping[str, Column],
    condition: Column | None = None,
    insert_values: Mapping[str, Column] | None = None,
    partition_by: str | None = None,
    schema: T.StructType | str | None = None,
    staged: bool = False,
) -> dict[str, int]:
    """Merge a batch into a stored table and return the rows inserted, updated and duplicate.

    The staged batch meets keys and condition columns of the target's files that may hold one of
    its keys, in an inner join: Spark broadcasts a small batch to the scan, so the table's keys
    are not shuffled. New rows are new files; of the table only the files with updated rows are
    written anew. Both are put in place by one swap, which an interruption delays and doesn't
    tear, so a repeated merge finds either none or all of it. The batch and what is known of its
    keys are written down first, and the rewrite and the counts see the same decisions whatever is
    recomputed; ``staged`` says that the batch is a stored table already. ``schema`` is the
    table's; without it the schemas of its files are merged.
    """
    options = write_options(keys[0])

    def even(rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *filter(None, [partition_by]))

    if not table_exists(spark, path):
        append(even(batch), path, partition_by, options)
        return {
            "insert": read_table(spark, path, batch.schema).count(), "update": 0, "duplicate": 0}
    finish_swaps(spark, path)
    table = read_table(spark, path, schema)
    with scratch(spark):
        if not staged:
            batch = stage(batch, "batch")
        with pushed_literals(spark, LITERALS):
            likely = narrowed(table, path, batch, keys)
            known = stage(known_keys(likely, batch, keys, condition), "known")
        decided = decisions(batch, known, keys)
        counts = _counts(decided)
        new = None
        if counts["insert"]:
            new = _inserted(table, decided.filter("_action = 'insert'"), insert_values)
        if counts["update"]:
            changed = decided.filter("_action = 'update'")
            # No more names than the table has files, which the driver lists anyway.
            files = [row[0] for row in changed.select("_file").distinct().collect()]
            affected = table.filter(F.col("_metadata.file_path").isin(files))
            changed = _updated(affected, changed.drop("_action", "_file"), keys, update_set)
            rewrite_table(changed, path, data_files(affected), partition_by, even, options, more=new)
        elif new is not None:
            rewrite_table(new, path, [], partition_by, even, options)
        return counts


def likely_rows(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A stored table without the files that can't hold a key of the (stored) batch."""
    return narrowed(read_table(spark, path, schema), path, batch, keys)


def _inserted(
    table: DataFrame, rows: DataFrame, insert_values: Mapping[str, Column] | None
) -> DataFrame:
    values = insert_values or _as_they_came(table, rows)
    return rows.alias("source").select(*(
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields))


def _updated(
    affected: DataFrame, changed: DataFrame, keys: Sequence[str], update_set: Mapping[str, Column]
) -> DataFrame:
    """All rows of the affected files; a left join, so that a small batch is broadcast."""
    joined = affected.alias("target").join(_marked(changed, "source"), _match(keys), "left")

    def value(name: str, kind) -> Column:
        if name not in update_set:
            return target(name)
        return F.when(F.col("_in_source"), update_set[name]).otherwise(target(name)).cast(
            kind).alias(name)

    return joined.select(*(value(f.name, f.dataType) for f in affected.schema.fields))


def known_keys(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], condition: Column | None
) -> DataFrame:
    """Batch keys that the table has, what becomes of them, and the file each is in."""
    located = table.withColumn("_file", F.col("_metadata.file_path"))
    return (
        batch.alias("source").join(located.alias("target"), _match(keys))
        .select(*[source(k).alias(k) for k in keys],
                _update_or_duplicate(condition).alias("_action"), target("_file").alias("_file"))
    )


def decisions(batch: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every batch row with its action and, where it is known, the file that it is in."""
    return batch.join(known, list(keys), "left").select(
        *batch.columns, F.coalesce("_action", F.lit("insert")).alias("_action"), "_file")


def _counts(rows: DataFrame) -> dict[str, int]:
    found = {r["_action"]: r["row_count"] for r in upsert_metrics(rows).collect()}
    return {action: found.get(action, 0) for action in ("insert", "update", "duplicate")}


def upsert_transactions(
    spark: SparkSession, path: str, batch: DataFrame, staged: bool = False
) -> dict[str, int]:
    """``upsert_latest`` on a stored table partitioned by event day."""
    return upsert_table(
        spark, path, batch, ["transaction_id"], {c: source(c) for c in UPDATABLE}, newer(),
        partition_by="event_date", schema=schemas.SILVER, staged=staged,
    )

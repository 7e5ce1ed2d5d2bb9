"""Running tallies of a message stream, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions.measures import rows

# Text fields only, so that the corrupt column is set by payloads that are no JSON at all.
_FIELDS = (
    "transaction_id string, status string, transaction_type string, _is_late_arrival string, "
    "_corrupt string"
)


def tally(bronze: DataFrame) -> DataFrame:
    """Messages by status and type, late ones, ones without id, unreadable ones."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    message = bronze.select(F.from_json("raw_payload", _FIELDS, options).alias("m"))
    readable = F.col("m._corrupt").isNull()

    def when_readable(condition, label):
        return F.when(readable & condition, label)

    labels = F.array(
        F.when(~readable, F.lit("parse_errors")),
        F.when(readable, F.lit("total")),
        when_readable(F.lit(True), F.concat(
            F.lit("status_"), F.coalesce("m.status", F.lit("unknown")))),
        when_readable(F.lit(True), F.concat(
            F.lit("type_"), F.coalesce("m.transaction_type", F.lit("unknown")))),
        when_readable(F.col("m._is_late_arrival") == "true", F.lit("late_arrivals")),
        when_readable(F.col("m.transaction_id").isNull(), F.lit("null_transaction_id")),
    )
    return (
        message.select(F.explode(labels).alias("stat")).filter(F.col("stat").isNotNull())
        .groupBy("stat").agg(rows().alias("n"))
    )

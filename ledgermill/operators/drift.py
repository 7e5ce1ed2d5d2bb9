"""Payload fields that the schema doesn't know: kept beside the typed columns, and reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgermill import schemas
from ledgermill.functions.measures import rows
from ledgermill.operators.clean import parse_payload


def unknown_fields(known: Sequence[str] | None = None) -> Column:
    """A payload's other fields as a map of variants; NULL where it has none or is no object."""
    known = known or T.StructType.fromDDL(schemas.PAYLOAD).names
    fields = F.try_parse_json("raw_payload").try_cast("map<string, variant>")
    other = F.map_filter(fields, lambda name, _: ~name.isin(list(known)))
    return F.when(F.size(other) > 0, other)


def parse_with_extra(bronze: DataFrame) -> DataFrame:
    """``parse_payload`` and ``extra``, the unknown fields as JSON text by name.

    A producer that is ahead of the schema loses nothing: what it adds lies beside the row until
    the schema has a column for it.
    """
    extra = F.transform_values(unknown_fields(), lambda _, value: F.to_json(value))
    return parse_payload(bronze, keep_raw=True).withColumn("extra", extra).drop("raw_payload")


def drift_report(
    bronze: DataFrame, known: Sequence[str] | None = None, by: str = "ingestion_date"
) -> DataFrame:
    """Per day and unknown field: the type that holds all its values, and how many rows have it."""
    fields = bronze.select(by, F.explode(unknown_fields(known)).alias("field", "value"))
    return fields.groupBy(by, "field").agg(
        F.schema_of_variant_agg("value").alias("kind"), rows().alias("row_count"))

"""String and domain expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def known_or(column: Column, domain: list[str], fallback: str) -> Column:
    """The value where the domain has it, else ``fallback``; NULL counts as unknown."""
    return F.when(column.isin(domain), column).otherwise(F.lit(fallback))


def draw(column: Column, purpose: str, sides: int) -> Column:
    """A repeatable number in ``0 .. sides-1`` from a row's key and a purpose label."""
    digest = F.md5(F.concat(column.cast("string"), F.lit(":" + purpose)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % sides


def pick(values: list[str], index: Column) -> Column:
    """``values[index]`` for a zero-based index column."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))

"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def day(value: str | dt.date | Column) -> Column:
    """A date literal from text or ``date``; a column passes through as a date."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def instant(value: str | dt.datetime | Column) -> Column:
    """A timestamp literal from text or ``datetime``; a column passes through."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def epoch_second(column: Column) -> Column:
    """Whole seconds since 1970."""
    return column.cast("timestamp").cast("bigint")


def older_than(event: Column, arrival: Column, minutes: int) -> Column:
    """True where the event lies strictly more than ``minutes`` before its arrival."""
    return event < arrival - F.make_dt_interval(mins=F.lit(minutes))

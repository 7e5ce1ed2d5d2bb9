"""Counts and means over a trailing range of time, for keys of any size.

A window over the key would bring all rows of a hot key to one task. These operators first
reduce the rows to one per key and time unit, which merges map-side and bounds what a key can
hold, run the window over those, and join the result back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.functions.measures import mean_from, rows, total
from ledgermill.functions.times import epoch_second


def trailing_count_per_second(
    events: DataFrame, key: str, second: str, seconds: int
) -> DataFrame:
    """Per key and second: rows in the ``seconds`` that end there, both ends and peers included.

    Time is cut into slots of ``seconds``, so a window reaches into one earlier slot at most. Each
    second also goes to the next slot, as part of what that slot starts with and as its removal
    once it is out of reach. The count is then a running sum: linear however long the window,
    and a hot key spreads over its slots, each holding two rows per second at most.
    """
    per_second = events.groupBy(key, second).agg(rows().alias("_rows"))
    slot, n = F.floor(F.col(second) / seconds), F.col("_rows")

    def entry(in_slot: Column, at: Column, change: Column, carried: Column, own: bool) -> Column:
        return F.struct(in_slot.alias("_slot"), at.alias("_at"), change.alias("_change"),
                        carried.alias("_carried"), F.lit(own).alias("_own"))

    entries = F.array(
        entry(slot, F.col(second), n, F.lit(0).cast("bigint"), True),
        entry(slot + 1, F.col(second) + seconds + 1, -n, n, False),
    )
    slots = Window.partitionBy(key, "_slot")
    return (
        per_second.select(key, second, F.inline(entries))
        .withColumn("_started", F.sum("_carried").over(slots))
        .withColumn("_since", F.sum("_change").over(slots.orderBy("_at")))
        .filter("_own")
        .select(key, second, (F.col("_started") + F.col("_since")).alias("trailing_count"))
    )


def with_trailing_count(
    df: DataFrame, name: str, key: str = "account_id", time: str = "timestamp",
    seconds: int = 600,
) -> DataFrame:
    """Every row with the number of its key's rows in the trailing ``seconds``."""
    timed = df.withColumn("_second", epoch_second(F.col(time)))
    counts = trailing_count_per_second(timed, key, "_second", seconds)
    return (
        timed.join(counts.withColumnRenamed("trailing_count", name), [key, "_second"])
        .drop("_second")
    )


def trailing_daily_mean(
    df: DataFrame, name: str, key: str, amount: str, day: str, days: int
) -> DataFrame:
    """Per key and day: mean amount over that day and the ``days`` before it."""
    daily = df.groupBy(key, day).agg(total(amount).alias("_amount"), rows().alias("_count"))
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    trailing = (
        Window.partitionBy(key).orderBy(number).rangeBetween(-days, Window.currentRow)
    )
    summed = daily.select(
        key, day, F.sum("_amount").over(trailing).cast("decimal(28,2)").alias("_amount"),
        F.sum("_count").over(trailing).alias("_count"),
    )
    return summed.select(key, day, mean_from(F.col("_amount"), F.col("_count")).alias(name))

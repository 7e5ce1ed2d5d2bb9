"""Aggregate expressions and ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

MONEY = "decimal(28,2)"
SALTS = 64


def rows() -> Column:
    """Row count. Silver ids are never NULL, so the (wide) id column need not be read."""
    return F.count(F.lit(1))


def total(column: Column | str, where: Column | None = None) -> Column:
    """Sum of money, zero where no row meets ``where``."""
    value = F.col(column) if isinstance(column, str) else column
    if where is None:
        return F.sum(value).cast(MONEY)
    return F.coalesce(F.sum(F.when(where, value)), F.lit(0)).cast(MONEY)


def mean_from(sum_: Column, count: Column) -> Column:
    """Mean of money from an exact sum and a count, with the type and rounding ``avg`` gives.

    Counted in millionths with the remainder taken off first: a plain decimal division would
    round once to its own scale and again to six digits.
    """
    cents = (F.abs(sum_) * 100).cast("decimal(30,0)")
    twice = F.nullif(count.cast("decimal(20,0)") * 2, F.lit(0).cast("decimal(20,0)"))
    halves = cents * 20_000 + count.cast("decimal(20,0)")
    millionths = (halves - halves % twice) / twice
    signed = F.when(sum_ < 0, -millionths).otherwise(millionths).cast("decimal(28,0)")
    return (signed * F.lit(Decimal("0.000001"))).cast("decimal(22,6)")


def beside(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys that may be NULL."""
    right = other.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return df.join(right, same).drop(*(f"_other_{k}" for k in keys))


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` in percent of ``whole``; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part * 100, whole), scale)


def nearest_rank(count: Column, share: float) -> Column:
    """The place, from 1, of a quantile among ``count`` ascending values, in whole numbers."""
    part = Fraction(str(share))
    up = count * part.numerator + (part.denominator - 1)
    return F.greatest(F.lit(1).cast("bigint"), ((up - up % part.denominator) / part.denominator).cast("bigint"))


def quantile_bounds(
    df: DataFrame, keys: Sequence[str], named: Mapping[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Per group the number of amounts and, for each quantile, two amounts that it lies between.

    They come from one sketch, asked for ranks that are ten times its error off. Every task ships
    a sketch per group, and a sketch may be large. The distinct count of a salt makes Spark merge
    the sketches of each salt first, so a group with a third of all rows is merged by many tasks
    and not by one. The count of salts itself is only there to be needed.
    """
    salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    off = 10 / accuracy
    shares = [x for q in named.values() for x in (max(0.0, q - off), min(1.0, q + off))]
    sketch = F.percentile_approx("amount", shares, accuracy)
    grouped = salted.groupBy(*keys).agg(
        F.count("amount").alias("_count"), sketch.alias("_bounds"),
        F.count_distinct("_salt").alias("_salts"))
    merged = F.when(F.col("_salts") > 0, F.col("_bounds"))
    return grouped.select(*keys, "_count", *(
        merged[2 * k + side].alias(f"_{name}{k}")
        for k in range(len(named)) for side, name in enumerate(("low", "high"))))


def quantiles_within(
    df: DataFrame, bounds: DataFrame, keys: Sequence[str], named: Mapping[str, float]
) -> DataFrame:
    """Exact amount quantiles (nearest rank) per group, from ``quantile_bounds``.

    Amounts between the bounds are counted one by one, those outside as what lies below the next
    lower bound: tasks merge their rows to some tenths of a percent of a group's amounts before
    anything is shuffled, and no group is in one task. That a quantile lies between its bounds is
    verified by its rank.
    """
    amount, found = F.col("amount"), range(len(named))
    within = [amount.between(F.col(f"_low{k}"), F.col(f"_high{k}")) for k in found]
    above = [F.when(F.col(f"_low{k}") > amount, F.col(f"_low{k}")) for k in found]
    inside = F.coalesce(reduce(Column.__or__, within), F.lit(False))
    counts = (
        beside(df.select(*keys, "amount"), bounds, keys)
        .withColumn("_inside", inside)
        .withColumn("_value", F.when(F.col("_inside"), amount).otherwise(
            F.least(*above) if len(above) > 1 else above[0]))
        .groupBy(*keys, "_count", "_value", "_inside").agg(rows().alias("_n")))
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_value"), "_inside")
    placed = counts.withColumn("_upto", F.sum("_n").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    row = F.struct("_upto", "_inside", "_value")
    picked = placed.groupBy(*keys, "_count").agg(*(
        F.min(F.when(F.col("_upto") >= nearest_rank(F.col("_count"), share), row)).alias(name)
        for name, share in named.items()))
    kind = df.schema["amount"].dataType
    return picked.select(*keys, *(
        F.when(F.col("_count") == 0, F.lit(None)).when(F.col(name)["_inside"], F.col(name)["_value"])
        .otherwise(F.raise_error(F.lit(f"{name} is outside its bounds")).cast(kind)).alias(name)
        for name in named))


def quantiles_by(
    df: DataFrame, keys: Sequence[str], others: Sequence[Column], named: Mapping[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact amount quantiles per group beside other aggregates, for groups that may be large.

    The bounds, a row a group, go to every task; the amounts are read once for them and once more
    between them.
    """
    bounds = F.broadcast(quantile_bounds(df, keys, named, accuracy))
    exact = quantiles_within(df, bounds, keys, named)
    return beside(df.groupBy(*keys).agg(*others), exact, keys)


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], named: Mapping[str, float],
    others: Sequence[Column] = (),
) -> DataFrame:
    """Exact amount quantiles (nearest rank) per group beside other aggregates, from rows of an
    ``amount`` and how often a group has it, ``n``: a row per group and amount.

    Rows with the same amount are one before a group meets in a task, which sorts its amounts and
    may spill them.
    """
    group = Window.partitionBy(*keys)
    n = F.when(F.col("amount").isNotNull(), F.col("n")).otherwise(0)
    placed = counts.withColumns({
        "_upto": F.sum(n).over(
            group.orderBy("amount").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_count": F.sum(n).over(group)})
    return placed.groupBy(*keys).agg(*others, *(
        F.min(F.when(F.col("_upto") >= nearest_rank(F.col("_count"), share), F.col("amount")))
        .alias(name) for name, share in named.items()))


def distinct_days(column: str, last_day: Column, span: int) -> Column:
    """Number of distinct days among the ``span`` days that end on ``last_day``.

    One bit per day in as many bigints as the span needs: a fixed-size buffer that merges
    map-side, where ``count_distinct`` would shuffle every (key, day) pair.
    """
    width = 62
    offset = F.datediff(last_day, F.col(column))
    found = F.lit(0)
    for start in range(0, span, width):
        within = offset.between(start, min(start + width, span) - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), offset - start)
        found = found + F.bit_count(F.coalesce(F.bit_or(F.when(within, bit)), F.lit(0)))
    return found.cast("bigint")

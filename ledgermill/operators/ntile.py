"""``ntile`` over a whole table without a single-task window.

A global ``ntile`` sorts every row in one task. Here the rows of all rankings are dealt to tasks by
ranges of (ranking, value, id) in one exchange and sorted there. A row's rank is its place in its
task plus the rows of the tasks before, and its tile follows from the rank. Sort keys end in a
unique id, so no value, however frequent, makes a range that cannot be cut.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.workspace import stage

# A monotonically increasing id has the task in its upper bits and the row in these.
_ROW_BITS = 33
_ROW = (1 << _ROW_BITS) - 1


def _tile(rank: Column, count: Column, tiles: int) -> Column:
    """Tile, from 1, of a rank, from 0: the first ``count % tiles`` tiles have a row more."""
    small, longer = F.floor(count / tiles), count % tiles
    in_longer = longer * (small + 1)
    return F.when(rank < in_longer, F.floor(rank / (small + 1)) + 1).otherwise(
        longer + F.floor(F.try_divide(rank - in_longer, small)) + 1).cast("int")


def ranks(df: DataFrame, orders: Mapping[str, Column], unique_id: str) -> DataFrame:
    """(id, ranking, rank, count): the place, from 0, of every row in every ranking."""
    values = F.array(*[
        F.struct(F.lit(k).alias("ranking"), order.cast("decimal(38,6)").alias("value"))
        for k, order in enumerate(orders.values())
    ])
    key = ["ranking", "value", "id"]
    placed = stage(
        df.select(F.col(unique_id).alias("id"), F.inline(values))
        .repartitionByRange(*key).sortWithinPartitions(*key)
        .select("id", "ranking", F.monotonically_increasing_id().alias("place")), "ranked")
    task = F.shiftrightunsigned("place", _ROW_BITS)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("size"))
    # One row per task from here to the join.
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sizes.select(
        "task", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"),
        (F.sum("size").over(Window.partitionBy()) / len(orders)).cast("bigint").alias("count")),
        "rank-starts")
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit(_ROW)) - F.col("ranking") * F.col("count")
    return placed.withColumn("task", task).join(starts, "task").select(
        "id", "ranking", rank.alias("rank"), "count")


def add_ntiles(
    df: DataFrame, tiles: int, orders: Mapping[str, Column], unique_id: str
) -> DataFrame:
    """A column ``ntile(tiles) over (order by <order>, <unique_id>)`` per entry of ``orders``.

    Orders are integers or decimals, ascending; negate for descending. ``df`` is read twice, so
    stage it first where computing it is dear.
    """
    tile = _tile(F.col("rank"), F.col("count"), tiles)
    wide = ranks(df, orders, unique_id).groupBy("id").agg(*[
        F.max(F.when(F.col("ranking") == k, tile)).alias(name) for k, name in enumerate(orders)])
    return df.join(wide.withColumnRenamed("id", unique_id), unique_id).select(
        *df.columns, *orders)

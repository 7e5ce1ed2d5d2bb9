"""Numbers along an order within each key, without a window that holds a key's rows in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgermill.workspace import stage

# A monotonically increasing id has the task in its upper bits and the row in these.
_ROW_BITS = 33
#: Messages of one key that one round sends.
ROUND = 100_000


def numbered(df: DataFrame, key: str, order: Sequence[str], name: str = "seq") -> DataFrame:
    """``df`` with the place, from 1, of each row among those of its key (never NULL).

    One range exchange by key and order, whose last column must tell a key's rows apart: a hot key
    is cut like any other range. A row's rank is its place in its task plus the rows of the tasks
    before; its number is its rank less its key's first.
    """
    by = [key, *order]
    placed = stage(
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id()), "placed")
    task = F.shiftrightunsigned("_place", _ROW_BITS)
    # One row per task from here to the join.
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("size")).select(
        "_task", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_start")), "task-starts")
    rank: Column = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = stage(
        placed.withColumn("_task", task).join(starts, "_task").withColumn("_rank", rank), "ranked")
    firsts = stage(ranked.groupBy(key).agg(F.min("_rank").alias("_first")), "firsts")
    return ranked.join(firsts, key).withColumn(
        name, F.col("_rank") - F.col("_first") + 1).select(*df.columns, name)


def send_in_order(
    rows: DataFrame, key: str, seq: str, send: Callable[[DataFrame], None], most: int = ROUND
) -> int:
    """Send numbered rows so that a key's go out one after another; the number of rounds.

    In a round each key's rows lie in one task, sorted, and there are at most ``most`` of them, so
    a hot key takes several rounds instead of one large task. Rounds follow each other.
    """
    dealt = stage(
        rows.withColumn("_round", F.floor((F.col(seq) - 1) / most)), "rounds", "_round")
    rounds = sorted(r[0] for r in dealt.select("_round").distinct().collect())
    for number in rounds:
        send(dealt.filter(F.col("_round") == number).drop("_round")
             .repartition(key).sortWithinPartitions(key, seq))
    return len(rounds)

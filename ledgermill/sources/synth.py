"""Faults for given rows: repeatable arithmetic on row ids, no random numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgermill.functions.text import draw, pick

# Shares of faulty rows in percent, and the fields a fault may erase.
DUPLICATE_PERCENT = 2
LATE_PERCENT = 5
NULL_PERCENT = 1
ERASABLE = ["transaction_id", "customer_id", "amount", "timestamp"]


def inject_faults(df: DataFrame) -> DataFrame:
    """Late events, erased fields and repeated deliveries, chosen by each row's own id.

    One projection: 5 % of rows move 10-45 minutes back, 1 % lose one of four fields, and 2 % of
    the resulting rows come twice.
    """
    row_id = F.col("transaction_id")
    late = draw(row_id, "late", 100) < LATE_PERCENT
    back = F.make_dt_interval(mins=(draw(row_id, "minutes", 36) + 10).cast("int"))
    erased = F.when(
        draw(row_id, "null", 100) < NULL_PERCENT, pick(ERASABLE, draw(row_id, "field", 4))
    ).otherwise(F.lit(""))
    repeats = F.when(
        draw(row_id, "repeat", 100) < DUPLICATE_PERCENT, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    marked = df.select(
        "*", late.alias("_late"), back.alias("_back"), erased.alias("_erased"),
        F.explode(repeats).alias("_delivery"),
    )
    event = F.col("timestamp")
    marked = marked.withColumns({
        "timestamp": F.when(F.col("_late"), event - F.col("_back")).otherwise(event),
        "_is_late_arrival": F.col("_late").cast("string"),
    })
    erase = {c: F.when(F.col("_erased") != c, F.col(c)) for c in ERASABLE}
    return marked.withColumns(erase).drop("_late", "_back", "_erased", "_delivery")

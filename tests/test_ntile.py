"""The distributed ntile against Spark's own window function."""

import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from ledgermill.operators import ntile


def check(df, tiles, orders):
    ours = ntile.add_ntiles(df, tiles, orders, "id")
    plain = df.select("*", *[
        F.ntile(tiles).over(Window.orderBy(order, "id")).alias(name)
        for name, order in orders.items()])
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3), max_size=60), tiles=st.integers(2, 7))
def test_small_tables(spark, values, tiles):
    df = spark.createDataFrame([(f"c{i:03d}", v) for i, v in enumerate(values)], "id string, v int")
    check(df, tiles, {"up": F.col("v"), "down": -F.col("v")})


def test_dominant_value(spark):
    """Most rows share one value; ranges stay small because keys end in the id."""
    chance = random.Random(7)
    rows = [(f"c{i:05d}", 1 if i % 5 else chance.randrange(1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, v int").repartition(6)
    check(df, 5, {"score": F.col("v")})


def test_mixed_types(spark):
    df = spark.range(5000).select(
        F.col("id"), (F.col("id") % 17).cast("int").alias("days"),
        (F.col("id") * 7919 % 1009).cast("decimal(28,2)").alias("money"))
    check(df, 5, {"recency": -F.col("days"), "monetary": F.col("money")})

"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.workspace import stage


def _jump(parents: DataFrame) -> DataFrame:
    """Follow parents to their roots; every round doubles the length of a step."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents = stage(
            parents.join(up, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved")),
            "parents")
        if parents.filter("moved").isEmpty():
            return parents.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; the root is its component's smallest node.

    ``edges`` has columns a and b. Each round hooks a node to its smallest neighbour, follows the
    hooks to their roots and contracts the edges; a round at least halves the nodes that still
    have edges. Every round's tables are written, so both sides of each join are read from disk
    and a hub's rows are split by adaptive execution. Loops and repeated edges do no harm, no
    edges give no rows.
    """
    ends = [F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")]
    left = stage(edges.select(*ends).filter("hi > lo").distinct(), "edges")
    labels = left.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    labels = stage(labels.select("node", F.col("node").alias("root")), "labels")
    while not left.isEmpty():
        parents = _jump(stage(
            left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent")), "hooks"))

        def root_of(df: DataFrame, column: str, parents: DataFrame = parents) -> DataFrame:
            up = parents.select(F.col("node").alias(column), F.col("parent").alias("up"))
            rest = [c for c in df.columns if c != column]
            return df.join(up, column, "left").select(
                *rest, F.coalesce("up", column).alias(column))

        labels = stage(root_of(labels, "root"), "labels")
        above = root_of(root_of(left, "hi"), "lo").select(
            F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))
        left = stage(above.filter("hi > lo").distinct(), "edges")
    return labels

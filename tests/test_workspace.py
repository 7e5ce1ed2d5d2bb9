"""Working tables, session helpers, scores."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgermill import workspace
from ledgermill.functions import measures, scoring
from ledgermill.functions.text import draw, pick


def test_scratch_cleans_up_after_success_only(spark):
    with workspace.scratch(spark):
        kept = workspace.stage(spark.range(3), "t")
        path = kept.inputFiles()[0].removeprefix("file:")
        assert kept.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)
    with pytest.raises(RuntimeError):
        with workspace.scratch(spark):
            path = workspace.stage(spark.range(3), "t").inputFiles()[0].removeprefix("file:")
            raise RuntimeError
    assert os.path.exists(path)


def test_shared_root_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert workspace.shared_root(spark).startswith(configured.rstrip("/"))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        applicationId, master = "app-1", "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        workspace.shared_root(Session())


def test_another_thread_keeps_its_tables(spark):
    """A streaming batch stages while the main thread is in a scope of its own."""
    made = []

    def batch():
        made.append(workspace.stage(spark.range(5), "other"))

    with workspace.scratch(spark):
        thread = threading.Thread(target=batch)
        thread.start()
        thread.join()
        workspace.stage(spark.range(3), "own")
    assert made[0].count() == 5


def test_nested_scopes(spark):
    with workspace.scratch(spark):
        outer = workspace.stage(spark.range(3), "outer")
        with workspace.scratch(spark):
            workspace.stage(spark.range(3), "inner")
        assert outer.count() == 3


def test_tiers_and_levels(spark):
    scores = spark.range(16).select(scoring.activity_tier(F.col("id")).alias("t")).collect()
    assert [r["t"] for r in scores] == (
        ["churned"] * 4 + ["at_risk"] * 2 + ["potential"] * 3 + ["loyal"] * 3 + ["champion"] * 4)
    levels = spark.range(12).select(
        scoring.outsized_level(F.col("id"), F.lit(1)).alias("l")).collect()
    assert [r["l"] for r in levels] == ["MEDIUM"] * 6 + ["HIGH"] * 5 + ["CRITICAL"]


def test_mean_rounds_like_avg(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("k"),
        ((F.col("id") * 7919 % 10007 - 5000) / 100).cast("decimal(18,2)").alias("m"))
    rows = df.groupBy("k").agg(
        F.avg("m").alias("a"),
        measures.mean_from(measures.total("m"), measures.rows()).alias("b")).collect()
    assert rows and all(r["a"] == r["b"] for r in rows)


def test_distinct_days_over_two_words(spark):
    df = spark.sql("SELECT date_sub(DATE '2024-03-31', CAST(id * 13 % 91 AS INT)) AS d "
                   "FROM range(60)")
    ours, plain = df.agg(
        measures.distinct_days("d", F.lit("2024-03-31").cast("date"), 91), F.count_distinct("d")
    ).first()
    assert ours == plain


def test_draw_and_pick(spark):
    draws = spark.range(1000).select(draw(F.col("id"), "x", 10).alias("d")).distinct()
    assert draws.count() == 10
    assert spark.range(1).select(pick(["a", "b"], F.lit(1))).first()[0] == "b"

"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source documents lie in key order; the order is
cut into ranges by the key's first hex digits, so a hot source is many tasks' work. Rows that are
equal in id and text share a key: those of one input task are one line of a range, so however
often a row is repeated a range has a line for each task at most. Prefix sums of the ranges' token
counts, of the lines inside a range and of the rows of a line give each document its place on the
source's line of tokens, and the line is cut at the source's budget, after as many whole passes
over the source as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANK, WORD, anchored, fresh
from ledgermill.workspace import stage

WEIGHTS, MOST, SEED = 3, 3, 17
#: Leading hex digits of the key that name a range: 4096 ranges of each source.
DIGITS = 3


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key(seed: int = SEED) -> Column:
    """Hex digits drawn from the id and the text."""
    part = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *part).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with ``target``: what each source shall give.

    Sources by code point, null last, weigh 1, 2, 3, 1 and so on, and share the sum of all sizes;
    none gets more than ``MOST`` times its size, and what is over goes to the others by weight.
    In order of size per weight the sources that stop at their limit come first, so the level at
    which the rest stand is found with running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % WEIGHTS + 1).cast("long"))
    wide = "decimal(38,0)"
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = (F.sum("source_size").over(every)
            - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("rest")
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.select("*", rest, open_weight.alias("open_weight"))
    limited = level.withColumn(
        "limited", F.col("rest").cast(wide) * F.col("weight").cast("decimal(18,0)")
        > (MOST * F.col("source_size")).cast(wide) * F.col("open_weight").cast("decimal(18,0)"))
    free = F.sum("source_size").over(every) - F.coalesce(
        F.sum(F.when(F.col("limited"), MOST * F.col("source_size"))).over(every), F.lit(0))
    share = F.sum(F.when(~F.col("limited"), F.col("weight"))).over(every)
    return limited.select(
        "source", "source_size",
        F.when(F.col("limited"), (MOST * F.col("source_size")).cast("double"))
        .otherwise((free * F.col("weight")).cast("double") / share.cast("double")).alias("target"))


def _placed(docs: DataFrame, carry: list[str], seed: int) -> DataFrame:
    """``carry``, ``source``, ``key``, ``size``, ``source_size``, ``target``, the whole ``passes`` over
    the source, and ``part``, the words taken of the row beyond these."""
    rows = stage(docs.select(
        *carry, F.col("doc_id").alias("id"), F.col("source").cast("string").alias("source"),
        tokens(F.col("text").cast("string")).alias("size"), key(seed).alias("key"),
        F.monotonically_increasing_id().alias("uid")), "sized")
    rows = rows.withColumn("range", F.substring("key", 1, DIGITS)).withColumn(
        "task", F.shiftrightunsigned("uid", 33))
    ranges = stage(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    wanted = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    budget = F.floor(F.col("target") + 0.5)
    wanted = stage(wanted.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
        .cast("long").alias("passes"), budget.cast("long").alias("budget")), "targets")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (ranges.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .withColumnRenamed("source", "name")
            .join(wanted, F.col("name").eqNullSafe(F.col("source")))
            .select(F.coalesce("source", F.lit("")).alias("c_source"), F.col("source").isNull().alias("c_null"),
                    F.col("range").alias("c_range"), "start", "source_size", "target", "passes",
                    (F.col("budget") - F.col("passes") * F.col("source_size")).alias("rest")))
    cuts = stage(cuts, "cuts")
    lines = rows.groupBy("source", "range", "key", "task").agg(
        F.max("size").alias("each"), F.count("*").alias("n"))
    place = Window.partitionBy("source", "range").orderBy("key", "task").rowsBetween(
        Window.unboundedPreceding, -1)
    lines = (lines.withColumn("inside", F.coalesce(F.sum(F.col("each") * F.col("n")).over(place), F.lit(0)))
             .withColumn("none", F.col("source").isNull())
             .withColumn("source", F.coalesce("source", F.lit(""))))
    lines = stage(lines.join(cuts, (lines.source == cuts.c_source) & (lines.none == cuts.c_null)
                             & (lines.range == cuts.c_range)).select(
        "source", "none", "key", "task", "source_size", "target", "passes",
        (F.col("rest") - F.col("start") - F.col("inside")).alias("left")), "lines")
    same = ["source", "none", "key", "task"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("uid")) - 1
    known = rows.withColumn("none", F.col("source").isNull()).withColumn(
        "source", F.coalesce("source", F.lit(""))).withColumn("nth", nth)
    part = F.greatest(F.lit(0), F.least("size", F.col("left") - F.col("nth") * F.col("size")))
    return known.join(lines, same).select(
        *carry, F.when(~F.col("none"), F.col("source")).alias("source"), "key", "size", "source_size",
        "target", "passes", part.cast("long").alias("part"))


def mix(docs: DataFrame, carry: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """``carry`` (``doc_id`` by default), ``size``, ``source_size``, ``target`` and ``taken`` of
    every row: the words that the mix takes of it, repeats counted.

    A source gives its target, rounded, to the word: all its words as often as they fit, then the
    documents first in key order, the last of them in part. Null and empty texts have size 0 and
    give nothing, a null source is a source. Rows with equal keys are equal in id and text, hence
    interchangeable; they come in input order. An empty table gives an empty one, other columns are
    not read, and reruns agree.
    """
    carry = carry or ["doc_id"]
    return _placed(docs, carry, seed).select(
        *carry, "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.col("part")).alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.split(text, rf"(?<={WORD[:-1]})(?={BLANK})"), F.lit(1), n), "")


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a row for every whole repeat and one for the part at a
    source's cut, its text up to the last word taken. Columns and their order stay.

    Null and empty texts, and those without a word, give nothing and go. A null source is a source;
    null ids and repeated rows are rows like any other. An empty table gives an empty one.

    A row's number of repeats follows from its key and its source's cut, so texts are not shuffled:
    they meet one line per source, and the rows at a cut, which the sizes alone tell apart.
    """
    rows, anchor = anchored(docs)
    placed = stage(_placed(rows.select("doc_id", "source", "text", *anchor), anchor, seed), "placed")
    cuts = placed.filter("size > 0").groupBy("source").agg(
        F.max("passes").alias("passes"),
        F.min(F.when(F.col("part") < F.col("size"), F.col("key"))).alias("cut"))
    names = {c: fresh(rows, f"mix_{c}") for c in ("key", "source", "passes", "cut", "part", "whole", "n")}
    cuts = stage(cuts, "source-cuts").select(*(F.col(c).alias(names[c]) for c in ("source", "passes", "cut")))
    at_cut = placed.join(cuts, F.col("source").eqNullSafe(F.col(names["source"]))
                         & (F.col("key") == F.col(names["cut"])))
    at_cut = stage(at_cut.select(*anchor, F.when(F.col("part") < F.col("size"), F.col("part"))
                                 .alias(names["part"])), "at-cut")
    c = {name: F.col(own) for name, own in names.items()}
    found = (
        rows.filter(F.col("text").cast("string").rlike(WORD)).withColumn(names["key"], key(seed))
        .join(cuts, F.col("source").cast("string").eqNullSafe(c["source"]))
        .join(at_cut.withColumn(names["whole"], F.lit(True)), anchor, "left"))
    # At the cut a row without a part of its own came whole.
    extra = F.when(c["whole"], c["part"].isNull()).otherwise(F.coalesce(c["key"] < c["cut"], F.lit(True)))
    whole = (c["passes"] + extra.cast("long")).cast("int")
    part = F.coalesce(c["part"], F.lit(0)).cast("int")
    copies = found.withColumn(names["whole"], whole).withColumn(
        names["n"], F.explode(F.sequence(F.lit(1), c["whole"] + F.lit(1))))
    copies = copies.filter((c["n"] <= c["whole"]) | (part > 0))
    text = F.when(c["n"] > c["whole"], first_words(F.col("text"), part)).otherwise(F.col("text"))
    return copies.select(*((text if x.lower() == "text" else F.col(f"`{x}`")).alias(x) for x in docs.columns))

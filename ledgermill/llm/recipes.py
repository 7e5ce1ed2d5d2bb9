"""Exact duplicates by content-defined chunks, with DataFrame functions only.

A text is cut where its own bytes say so: at the first place, ``LEAST`` bytes or more after the
last cut, behind two bytes that are 4 modulo 8; after ``MOST`` bytes at the latest. A chunk's
identifier is its hash, verified by comparing contents: equal hashes with different contents are
told apart by an ordinal. A text's recipe is the ordered list of its chunks' identifiers, and two
texts are equal when their recipes are. Contents move once, as distinct chunks of each task;
documents are grouped and joined as recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import anchored, computed, lower_az
from ledgermill.workspace import stage

LEAST, MOST = 256, 4096
_CUT = "[" + "".join(rf"\x{b:02x}" for b in range(4, 256, 8)) + "]"
#: Lazy up to the first cut, else as much as there is.
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?(?<={_CUT}{_CUT})|.{{1,{MOST}}}"


def normal(text: Column) -> Column:
    """What is compared: A-Z lower-cased, null as empty."""
    return lower_az(F.coalesce(text.cast("string"), F.lit("")))


def chunks(normal_text: Column) -> Column:
    """A text's chunks; each byte is one character of them, so a cut may lie inside a letter."""
    return F.regexp_extract_all(
        F.decode(F.encode(normal_text, "UTF-8"), "ISO-8859-1"), F.lit(CHUNK), F.lit(0))


def digest(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def collided(pieces: DataFrame) -> DataFrame:
    """Of (h, chunk), the hashes that have more than one content."""
    return pieces.groupBy("h").agg(F.countDistinct("chunk").alias("n")).filter("n > 1").select("h")


def recipes(docs: DataFrame, carry: list[str], hashed=digest) -> DataFrame:
    """``carry``, ``uid``, ``text_sha256``, ``recipe`` and ``ordinals`` of every row, written.

    ``uid`` is unique; ``ordinals`` is empty unless a hash of the row has several contents.
    """
    text = computed(docs, carry, normal_text=normal(F.col("text")))
    cut = computed(text, carry, text_sha256=F.sha2("normal_text", 256), chunks=chunks(F.col("normal_text")))
    rows = stage(cut.select(*carry, F.monotonically_increasing_id().alias("uid"), "text_sha256",
                            F.transform("chunks", hashed).alias("recipe")), "recipes")

    def pieces(df: DataFrame, *more: str) -> DataFrame:
        return df.select(*more, F.explode("chunks").alias("chunk")).select(
            *more, "chunk", hashed(F.col("chunk")).alias("h"))

    twice = stage(collided(pieces(cut)), "collided")
    if twice.isEmpty():  # every hash has one content: the hashes are the verified identifiers
        return rows.withColumn("ordinals", F.array().cast("array<int>"))
    # Contents of the hashes in question, numbered, and every recipe in which they occur.
    contents = pieces(cut).join(twice, "h", "left_semi").distinct()
    number = F.row_number().over(Window.partitionBy("h").orderBy("chunk"))
    numbered = stage(contents.withColumn("ordinal", number), "numbered")
    affected = (rows.select("uid", "text_sha256", F.explode("recipe").alias("h"))
                .join(twice, "h", "left_semi").select("uid").distinct())
    marked = cut.select("text_sha256", "chunks").join(
        rows.join(affected, "uid", "left_semi").select("text_sha256", "recipe").distinct(),
        "text_sha256", "left_semi").dropDuplicates(["text_sha256", "chunks"])
    found = (marked.withColumn("copy", F.monotonically_increasing_id())
             .select("copy", "text_sha256", "chunks"))
    found = stage(found, "affected")
    places = found.select("copy", F.posexplode("chunks").alias("place", "chunk")).withColumn(
        "h", hashed(F.col("chunk")))
    ordinals = (places.join(numbered, ["h", "chunk"], "left")
                .groupBy("copy").agg(F.sort_array(F.collect_list(F.struct(
                    "place", F.coalesce("ordinal", F.lit(0)).alias("o")))).alias("s"))
                .select("copy", F.transform("s", lambda x: x["o"]).alias("ordinals")))
    told = stage(found.join(ordinals, "copy").select("text_sha256", "ordinals"), "ordinals")
    return stage(rows.join(told, "text_sha256", "left").withColumn(
        "ordinals", F.coalesce("ordinals", F.array().cast("array<int>"))), "recipes")


def duplicates(docs: DataFrame, carry: list[str] | None = None, hashed=digest) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: ``carry`` (``doc_id`` by default, and it must
    be among them), ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are after lower-casing A-Z; null counts as empty. The row with the
    largest ``doc_id`` stays; null ids are below all others, and of rows with the same id one
    stays. ``keep_id`` is null only where all ids of a group are. An empty table gives an empty
    one; other columns are not read.
    """
    carry = carry or ["doc_id"]
    rows = recipes(docs, carry, hashed).withColumn("key", F.xxhash64("recipe", "ordinals"))
    groups = stage(
        rows.groupBy("key", "recipe", "ordinals")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "uid")).alias("last"))
        .filter("group_size > 1"), "groups")
    return rows.join(groups, ["key", "recipe", "ordinals"], "left").select(
        *carry,
        F.when(F.col("last").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("last").isNull() | (F.col("last.uid") == F.col("uid"))).alias("kept"),
        "text_sha256")


def keep_last(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``duplicates`` drops; columns and their order stay.

    Null text counts as empty, so of null and empty texts together one row stays. Of repeated rows
    and of rows with the same or no id one stays, too. An empty table gives an empty one.
    """
    rows, anchor = anchored(docs)
    found = duplicates(rows.select("doc_id", "text", *anchor), ["doc_id", *anchor])
    dropped = stage(found.filter(~F.col("kept")).select(*anchor), "dropped")
    return rows.join(dropped, anchor, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))

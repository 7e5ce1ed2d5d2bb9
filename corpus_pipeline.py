"""A training-data pipeline over ``documents``.

``STAGES`` lists its stages; each takes (spark, docs, sf_dir) and returns a frame that is written
as Parquet and read again as the next one's docs. All but the last return the columns of
documents. Each stage's handling of nulls, empty and long texts, ties, repeated rows, empty tables
and other columns is that of the operator it calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import bpe, langid, mix, recipes, simhash
from ledgermill.llm.common import table
from ledgermill.workspace import new_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language learned from the documents; those without a letter or one go."""
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return recipes.keep_last(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints link, directly or by others, the one with the smallest id."""
    return simhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows repeat, go, or are cut at a source's budget."""
    return mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, their number, and digests of ids and decoded text."""
    return bpe.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixing),
    ("bpe", tokens),
]

#: SQL can express neither the language profiles nor the fingerprints nor the encoder.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

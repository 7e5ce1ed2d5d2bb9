"""The pipeline's stages on a folder of documents, and its queries."""

import corpus_pipeline
import pytest
from llm.examples import bag

from checks.compare import connect, difference
from ledgermill.llm import bpe, catalog, langid, mix, recipes, simhash
from ledgermill.workspace import new_path

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    found = difference(QUERIES[name](spark, FOLDER), duck, SQL[name])
    assert found is None, found


def test_a_query_for_every_operator():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]


def test_stages_apply_the_operators(spark, docs):
    """Each stage's rows are those that its operator's general form says."""
    frame, path = docs, None
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, name)
        stage(spark, frame, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        if name == "language":
            known = langid.identify(frame).filter("lang_pred != 'und' and score > 0")
            assert bag(out, "doc_id") == bag(known, "doc_id")
        if name == "exact_dedup":
            assert bag(out, "doc_id") == bag(recipes.duplicates(frame).filter("kept"), "doc_id")
        if name == "near_dedup":
            assert bag(out, "doc_id") == bag(simhash.near_duplicates(frame).filter("doc_id = component_id"), "doc_id")
        if name == "mixing":
            taken = mix.mix(frame).selectExpr("sum(taken)").first()[0]
            assert out.select(mix.tokens(out.text)).groupBy().sum().first()[0] == taken
        if name == "bpe":
            assert bag(out) == bag(bpe.digests(frame))
        else:
            assert out.columns == docs.columns
        frame = out


def test_empty_documents(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_other_columns_go_through(spark, clashing, docs, tmp_path):
    clashing.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/b/documents.parquet")
    runs = [corpus_pipeline.run(spark, f"{tmp_path}/{x}") for x in "ab"]
    assert bag(runs[0]) == bag(runs[1])

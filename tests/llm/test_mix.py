"""Mixing against water-filling and cutting in plain Python."""

import re
from collections import defaultdict
from fractions import Fraction

import pytest
from llm.examples import bag
from pyspark.sql import functions as F

from ledgermill.llm import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by repeated resharing, exact."""
    weight = {s: Fraction(k % 3 + 1) for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    fixed, total = {}, Fraction(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in fixed]
        share = sum((weight[s] for s in free), Fraction(0))
        level = {s: (total - sum(fixed.values())) * weight[s] / share for s in free}
        over = [s for s in free if level[s] > 3 * sizes[s]]
        if not over:
            return fixed | level
        fixed |= {s: Fraction(3 * sizes[s]) for s in over}


def check(docs):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "text").collect()]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want, got = water(sizes), defaultdict(int)
    found = mix.mix(docs.withColumn("s", F.col("source")), ["doc_id", "s"]).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["s"]]
        assert r["target"] == pytest.approx(float(want[r["s"]]), rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[r["s"]] += r["taken"]
    for s in sizes:
        assert got[s] == int(want[s] + Fraction(1, 2))


def test_targets_and_budgets(docs):
    check(docs)


def test_limited_sources(spark):
    texts = [("a", 900), ("b", 1), ("c", 2), ("d", 40), ("e", 3), (None, 1), ("g", 0)]
    rows = [(k, "w " * n, s) for k, (s, n) in enumerate(texts)] + [(50 + k, "x y z", "a") for k in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_mixed_rows_hold_what_is_taken(docs, clashing, none):
    out = mix.mixed(docs)
    assert out.columns == docs.columns
    found = defaultdict(int)
    for r in out.collect():
        found[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    taken = defaultdict(int)
    for r in mix.mix(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in taken.items() if v} == dict(found)
    texts = {r["text"] for r in docs.collect() if r["text"]}
    assert all(any(t.startswith(r["text"]) for t in texts) for r in out.collect())
    assert bag(mix.mixed(clashing), *docs.columns) == bag(out)
    assert mix.mixed(none).count() == 0


def test_reruns_empty_and_clashing(docs, clashing, none):
    assert bag(mix.mix(docs)) == bag(mix.mix(docs.repartition(7)))
    assert bag(mix.mix(clashing)) == bag(mix.mix(docs))
    assert mix.mix(none).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert {r["taken"] for r in mix.mix(blank).collect()} == {0}


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\tc ", 2), ("a", 1), ("a b", 0)], "t string, n int")
    assert [r[0] for r in df.select(mix.first_words(F.col("t"), F.col("n"))).collect()] == [" a  b", "a", ""]


def test_no_python_on_the_main_path(docs):
    plan = mix.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_repeated_row_is_no_long_group(spark):
    """A third of all rows are one row without an id: a range has a line per task, not per row."""
    rows = [(None, "same words again", "a")] * 600 + [(k, "w " * (k % 9), "ab"[k % 2]) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    check(df)
    taken = [r["taken"] for r in mix.mix(df).filter("doc_id IS NULL").collect()]
    assert len(taken) == 600 and sum(1 for t in taken if t % 3) <= 1

"""Exact shard sizes and a uniform shuffle."""

import random
import zlib
from collections import Counter

import numpy as np
from llm.examples import bag

from ledgermill.llm import shards


def test_every_row_once_sizes_and_slots(docs):
    rows = shards.shuffle(docs).collect()
    want = sorted(repr((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())))
                  for r in docs.collect())
    assert sorted(repr((r["doc_id"], r["size"], r["text_crc32"])) for r in rows) == want
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_parts_of_a_shard_join_up(spark, monkeypatch):
    monkeypatch.setattr(shards, "PART", 10)
    df = spark.range(0, 3000, 1, 7).selectExpr("id AS doc_id", "string(id) AS text")
    rows = shards.shuffle(df, 5).collect()
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(600))
    places = np.array([r["shard"] * 600 + r["slot"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    assert abs(np.corrcoef(places, np.arange(3000))[0, 1]) < 0.08


def test_matrix_sums():
    cells, sizes = [5, 0, 17, 100, 3], shards.sizes(125, 7)
    m = np.array(shards.matrix(cells, sizes, 1))
    assert m.sum(axis=1).tolist() == cells and m.sum(axis=0).tolist() == sizes and m.min() >= 0


def test_hypergeometric_follows_its_law():
    rng = random.Random(2)
    drawn = Counter(shards.hypergeometric(6, 9, 5, rng) for _ in range(20_000))
    from math import comb

    for k in range(6):
        p = comb(6, k) * comb(9, 5 - k) / comb(15, 5)
        assert abs(drawn[k] / 20_000 - p) < 5 * (p / 20_000) ** 0.5 + 1e-3
    big = [shards.hypergeometric(10**12, 10**13, 10**9, rng) for _ in range(300)]
    assert abs(np.mean(big) - 10**9 / 11) < 4 * (10**9 * 10 / 121) ** 0.5 / 300**0.5


def test_fewer_rows_than_shards_empty_and_clashing(docs, clashing, none):
    assert sorted(r["shard"] for r in shards.shuffle(docs.limit(3)).collect()) == [0, 1, 2]
    assert shards.shuffle(none).count() == 0
    assert shards.shuffle(clashing).columns == shards.shuffle(docs).columns


def test_same_files_same_shards(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert bag(shards.shuffle(df)) == bag(shards.shuffle(df))


def test_no_python_on_the_main_path(docs):
    plan = shards.shuffle(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Importance resampling: models, exact top-k, and what it keeps."""

import numpy as np
import pytest
from llm.examples import bag

from ledgermill.llm import resample

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return (spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_ratios_are_those_of_plain_counts(spark, labelled):
    docs, labels = labelled
    good = labels.filter("quality = 1").select("doc_id")
    ids = {r["doc_id"] for r in good.collect()}
    counts = np.ones((2, resample.BUCKETS))
    for r in docs.collect():
        f = np.bincount(resample.features(r["text"]), minlength=resample.BUCKETS)
        counts[0] += f
        counts[1] += f * (r["doc_id"] in ids)
    share = counts / counts.sum(axis=1, keepdims=True)
    assert np.allclose(resample.log_ratios(docs.select("doc_id", "text"), good), np.log(share[1] / share[0]))


def test_keeps_the_largest_keys_and_good_texts(labelled):
    docs, labels = labelled
    rows = resample.resample(docs, labels).collect()
    k = sum(r["kept"] for r in rows)
    good = [r["quality"] for r in labels.collect()]
    assert k == int(sum(good) / len(good) * len(rows) + 0.5)
    assert min(r["gumbel_key"] for r in rows if r["kept"]) >= max(r["gumbel_key"] for r in rows if not r["kept"])
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = {q: np.mean([r["kept"] for r in rows if quality.get(r["doc_id"]) == q]) for q in (0, 1)}
    assert kept[1] > kept[0] + 0.3, kept


def test_reruns_agree(labelled):
    assert bag(resample.resample(*labelled)) == bag(resample.resample(labelled[0].repartition(5), labelled[1]))


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000, 2000])
def test_top_is_exact_with_ties(spark, k):
    rng = np.random.default_rng(k)
    values = rng.normal(size=1000).round(1) * 10.0 ** rng.integers(-3, 4, 1000)
    df = spark.createDataFrame([(u, float(v)) for u, v in enumerate(values)], "uid long, v double")
    found = df.filter(resample.top(df, "v", "uid", k)).collect()
    want = sorted(((float(v), u) for u, v in enumerate(values)), reverse=True)[:k]
    assert sorted((r["v"], r["uid"]) for r in found) == sorted(want)


def test_gumbel_draws_in_proportion():
    rng = np.random.default_rng(3)
    weight = np.log([1, 2, 5])
    first = [(weight - np.log(-np.log(rng.random(3)))).argmax() for _ in range(20_000)]
    assert np.allclose(np.bincount(first) / 20_000, [1 / 8, 2 / 8, 5 / 8], atol=0.02)


def test_defined_cases(spark, docs, clashing, none):
    labels = spark.createDataFrame([(9, 1, 0), (9, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 1), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = resample.resample(docs, labels)
    assert rows.count() == docs.count()
    assert {r["log_weight"] for r in rows.filter("doc_id in (1, 2)").collect()} == {0.0}
    assert bag(resample.resample(clashing, labels)) == bag(rows)
    assert resample.resample(none, labels).count() == 0
    assert resample.resample(docs, labels.limit(0)).filter("kept").count() == docs.count()
    assert resample.resample(docs, labels, share=0.0).filter("kept").count() == 0


def test_same_rows_as_brute_force(spark, docs):
    """Weights, keys and what is kept, from counts of buckets in plain Python."""
    import math
    import zlib
    from collections import Counter

    import xxhash

    df = docs.filter("length(text) < 2000 OR text IS NULL")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    quality = {i: int(zlib.crc32(str(i).encode()) % 3 > 0) for i, _ in rows if i is not None and i % 2 == 0}
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int")
    raw, good = Counter(), Counter()
    for i, text in rows:
        found = resample.features(text).tolist()
        raw.update(found)
        if quality.get(i):
            good.update(found)
    every = [sum(c.values()) + resample.BUCKETS for c in (raw, good)]
    ratio = {b: math.log((good[b] + 1) / every[1]) - math.log((raw[b] + 1) / every[0]) for b in raw}
    want = []
    for i, text in rows:
        weight = sum(ratio[b] for b in resample.features(text).tolist())
        u = ((xxhash.xxh64_intdigest(f"{resample.SEED}|{i}|{text or ''}".encode()) >> 11) + 0.5) / (1 << 53)
        want.append((i, weight, weight - math.log(-math.log(u))))
    keep = int(sum(quality.values()) / len(quality) * len(rows) + 0.5)
    order = lambda r: (-r[2], r[0] is None, r[0] or 0)
    want.sort(key=order)
    got = sorted(((r["doc_id"], r["log_weight"], r["gumbel_key"], r["kept"])
                  for r in resample.resample(df, labels).collect()), key=order)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(abs(a - b) < 1e-6 for g, w in zip(got, want) for a, b in zip(g[1:3], w[1:]))
    # Rows that are equal in id and text may stand for each other at the cut.
    assert sum(r[3] for r in got) == keep
    last = want[keep - 1][2]
    assert all(r[3] == (r[2] > last) for r in got if abs(r[2] - last) > 1e-6)

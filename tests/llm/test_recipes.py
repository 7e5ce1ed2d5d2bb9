"""Exact duplicates by recipes against grouping whole texts."""

import hashlib
import random
import re

from llm.examples import bag, words
from pyspark.sql import functions as F

from ledgermill.llm import recipes


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower(r["text"]), []).append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        spent = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            kept = i == keep and not spent
            spent = spent or kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_same_as_whole_texts(docs):
    assert found(recipes.duplicates(docs)) == brute(docs.collect())


def test_equal_hashes_with_different_contents(spark, docs):
    """With four hash values nearly all chunks collide, and the ordinals must tell them apart."""
    rng = random.Random(1)
    texts = [words(rng, 300) for _ in range(6)]
    swapped = [texts[0] + texts[1], texts[1] + texts[0], texts[0] + texts[1]]
    rows = [(k, t, "en", "a", 1) for k, t in enumerate(texts + swapped + texts[:2])]
    df = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    weak = recipes.duplicates(df, hashed=lambda c: F.pmod(F.xxhash64(c), F.lit(4)).cast("long"))
    assert found(weak) == brute(df.collect())


def test_chunks_give_the_text_back_and_resist_shifts(spark):
    rng = random.Random(2)
    text = words(rng, 20_000) + "É日本" * 500 + "a" * 9000
    shifted = "some words in front " + text
    df = spark.createDataFrame([(text,), (shifted,), ("",)], "text string")
    one, two, empty = (r["c"] for r in df.select(recipes.chunks(recipes.normal(F.col("text"))).alias("c")).collect())
    assert "".join(one).encode("latin-1").decode() == text and empty == []
    assert max(map(len, one)) <= recipes.MOST
    assert len(set(one) & set(two)) > 0.9 * len(set(one))


def test_only_ascii_letters_fold(spark):
    df = spark.createDataFrame([(1, "É A"), (2, "é a"), (3, "É a")], "doc_id long, text string")
    assert {r["doc_id"]: r["keep_id"] for r in recipes.duplicates(df).collect()} == {1: 3, 2: 2, 3: 3}


def test_keep_last(docs, clashing, none):
    kept = recipes.keep_last(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    dropped = {1, 4, 9}
    assert ids == sorted({r["doc_id"] for r in docs.collect() if r["doc_id"] is not None} - dropped)
    assert bag(recipes.keep_last(clashing), *docs.columns) == bag(kept)
    assert recipes.keep_last(none).count() == 0


def test_empty_and_clashing(docs, clashing, none):
    assert recipes.duplicates(none).count() == 0
    assert bag(recipes.duplicates(clashing)) == bag(recipes.duplicates(docs))


def test_no_python_on_the_main_path(docs):
    plan = recipes.duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Language profiles: held-out accuracy and the defined cases."""

import zlib

import numpy as np
from llm.examples import bag

from ledgermill.llm import langid


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_learned_rows_and_texts_count(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoilt = df.selectExpr(
        "doc_id", "text", "IF(crc32(string(doc_id)) % 4 = 2, 'zz', lang) AS lang", "'x' AS source", "n_chars")
    assert bag(langid.identify(spoilt)) == bag(langid.identify(df))


def test_defined_cases(docs, clashing, none):
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 6, 7):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[4]["lang_pred"] == by_id[5]["lang_pred"] != "und"
    assert not by_id[None]["held_out"]
    assert bag(langid.identify(clashing)) == bag(langid.identify(docs))
    assert langid.identify(none).count() == 0
    nothing = docs.selectExpr("doc_id", "text", "string(null) AS lang")
    assert {r["lang_pred"] for r in langid.identify(nothing).collect()} == {"und"}


def test_keep_known(docs, clashing, none):
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1, 2, 6, 7} and {3, 4, 9, 10} <= ids
    assert bag(langid.keep_known(clashing), *docs.columns) == bag(kept)
    assert langid.keep_known(none).count() == 0


def test_grams_and_vectors():
    text = lambda g: "".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0))
    assert [text(g) for g in langid.grams("Ab, c1")] == [" ab", "ab ", "b c", " c "]
    assert len(langid.grams("12 !")) == 0
    a, b = (langid._Vectors.bind(int(g)) for g in langid.grams("ab")[:2])
    assert set(a.tolist()) == {1, -1} and abs(int(a.astype(int) @ b)) < 200
    grams = langid.grams("abc abd abe abc")
    alone = langid.bundle([0], [grams], 1)[0]
    assert np.array_equal(alone, sum(langid._Vectors.bind(int(g)).astype(int) for g in grams))


def test_many_grams_go_beyond_what_is_kept(monkeypatch):
    monkeypatch.setattr(langid, "_KEPT", 10)
    vectors = langid._Vectors()
    grams = np.unique(langid.grams("the quick brown fox jumps over the lazy dog"))
    for _ in range(2):
        assert np.array_equal(vectors.of(grams), [vectors.bind(int(g)) for g in grams])
    assert len(vectors.at) == 10


def plain(rows):
    """(language, cosine) of each text by sums over its n-grams, one after another."""
    def vector(text):
        return sum((langid._Vectors.bind(int(g)).astype(float) for g in langid.grams(text or "")),
                   np.zeros(langid.DIMENSIONS))

    made = {}
    for i, text, lang in rows:
        if i is not None and text is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            v = vector(text)
            if v.any() or len(langid.grams(text)):
                made[lang] = made.get(lang, 0) + v
    out = []
    for i, text, _ in rows:
        v = vector(text)
        if not len(langid.grams(text or "")) or not made:
            out.append((i, "und", 0.0))
            continue
        cosine = {x: float(v @ p) / max(1, np.linalg.norm(v)) / max(1, np.linalg.norm(p)) for x, p in made.items()}
        best = max(sorted(cosine), key=cosine.get)
        out.append((i, best, min(1.0, max(0.0, cosine[best]))))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[2], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], atol=1e-9)


def test_same_as_brute_force(spark, docs):
    df = docs.filter("length(text) < 2000 OR text IS NULL")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    same([(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(df).collect()], plain(rows))


def test_more_languages_than_a_block(spark):
    """1001 languages; and the same predictions in blocks of any size."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(1001)]
    rows = [(k, f"{w} {w}", f"l{k:04d}") for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(df).collect()
    learned = [r for r in found if not r["held_out"]]
    assert len(found) == 1001
    assert np.mean([r["lang_pred"] == f"l{r['doc_id']:04d}" for r in learned]) > 0.99
    path = langid.learn(df)
    import pyarrow as pa
    texts = pa.array([r[1] for r in rows[:60]] + ["", None])
    (some, low), (every, high) = (langid.predictor(path, block)(texts) for block in (7, 5000))
    assert some == every and np.allclose(low, high, atol=1e-12)

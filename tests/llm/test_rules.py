"""Quality rules against plain Python."""

import random
import re
from collections import Counter

from llm.examples import bag, words

from ledgermill.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def texts():
    rng = random.Random(3)
    out = [words(rng, 5, "ab") for _ in range(20)]
    for _ in range(60):
        part = words(rng, rng.randint(3, 30), "abc")
        out.append(" ".join([words(rng, rng.randint(0, 20)), part, words(rng, rng.randint(0, 9)), part, part]))
    return [*out, "a\nb\na\n\n \n \nb", "x " * 500, "# * <a> %€ " * 9, " ".join(["a b c d e f g h"] * 3), None, ""]


def test_measures(spark, docs):
    rows = [(k, t) for k, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in rules.judge(df).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        want = measures(rows[r["doc_id"]][1])
        assert got == want, rows[r["doc_id"]]
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    for r in rules.judge(docs.filter("doc_id in (4, 5)")).collect():
        assert r["n_words"] == 30_000


def test_verdict(spark):
    rng = random.Random(4)
    clean = " ".join(f"the {words(rng, 3)} and" for _ in range(20))
    bad = [words(rng, 60), clean + " $$$" * 60, "\n".join(["the and of"] * 2 + ["a"] * 30), "the " + "x" * 3000 + clean]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([clean, *bad])], "doc_id long, text string")
    assert [r["kept"] for r in rules.judge(df).orderBy("doc_id").collect()] == [True] + [False] * 4


def test_a_table_is_one_projection(docs):
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Aggregate" not in plan


def test_empty_and_clashing(docs, clashing, none):
    assert rules.judge(none).count() == 0
    assert bag(rules.judge(clashing)) == bag(rules.judge(docs))
    assert rules.judge(docs).count() == docs.count()

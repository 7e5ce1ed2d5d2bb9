"""Hard negatives against plain Python, and the exactness of the products."""

import math
import random

import numpy as np
import pytest
from llm.examples import bag
from pyspark.sql import functions as F

from ledgermill.llm import negatives

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    taken = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        taken.append((k, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    order = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))
    out = []
    for k, i, label, v in taken:
        if i is None or i % 100:
            continue
        score = [(sum(x * y for x, y in zip(v, w)), j, m, other) for m, j, other, w in taken]
        for p in order([s for s in score if s[3] == label and s[2] != k])[:5]:
            window = [s for s in score if s[3] != label and 30 * p[0] <= 100 * s[0] <= 90 * p[0]]
            out += [repr((i, p[1], rank, n[1], p[0], n[0])) for rank, n in enumerate(order(window)[:10], 1)]
    return sorted(out)


def rows(n, seed, width=8, step=1):
    rng = random.Random(seed)
    grid = [x / 8 for x in range(-3, 5)]  # coarse values, so many scores tie
    return [(k * step, [rng.choice(grid) for _ in range(width)], rng.randrange(4)) for k in range(n)]


AWKWARD = [
    (None, [0.5] * 8, 1), (None, [0.5] * 8, 2), (100, [0.5] * 8, 1), (100, [0.5] * 8, 1), (200, None, 1),
    (300, [0.5] * 8, None), (400, [0.5] * 7 + [None], 1), (500, [float("nan")] * 8, 1), (600, [float("inf")] * 8, 1),
    (-700, [-0.5] * 8, 9), (700, [], 3), (800, [0.5, 0.25], 3), (801, [1.0] * 12, 3), (802, [0.4] * 12, 5),
    (900, [0.0] * 8, 4), (901, [0.0] * 8, 4), (902, [0.0] * 8, 5), (1000, [-1.0] * 8, 6), (1001, [1.0] * 8, 6),
]


@pytest.mark.parametrize("shape", [(65, 33, 70), (1, 1, 1), (100, 64, 128), (3, 90, 200), (0, 5, 4), (128, 0, 3)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_products_are_exact(shape, leaf):
    rng = np.random.default_rng(1)
    m, k, n = shape
    for most in (150, 1 << 28):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_intermediate_overflow_does_no_harm():
    a = np.array([[1 << 40, 3], [5, -(1 << 40)]])
    b = np.array([[1 << 20, 7], [1, 1 << 21]])
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a])
    assert (negatives.strassen(a, b, 1) == want).all()


def test_same_as_brute_force(spark):
    for seed, width in ((1, 8), (2, 3)):
        given = rows(330, seed, width) + AWKWARD
        df = spark.createDataFrame(given, EMBEDDINGS).repartition(3, "vec_id")
        got = sorted(repr(tuple(r)) for r in negatives.hard_negatives(df).collect())
        assert got == brute(given) and got


def test_small_tiles_and_many_tasks(spark, monkeypatch):
    given = rows(260, 3) + AWKWARD
    df = spark.createDataFrame(given, EMBEDDINGS)
    # Tiles of a few rows are cut on the driver's side only; heaps of many tasks must still merge.
    monkeypatch.setattr(negatives, "LEAST", 20)
    monkeypatch.setattr(negatives, "MOST", 30)
    assert sorted(repr(tuple(r)) for r in negatives.hard_negatives(df).collect()) == brute(given)


def test_heaps_merge_like_one_sort():
    rng = np.random.default_rng(4)
    scores, allowed = rng.integers(0, 6, (7, 90)), rng.random((7, 90)) < 0.6
    heaps = negatives.Heaps(7, 5)
    for at in range(0, 90, 11):
        heaps.offer(scores[:, at:at + 11], allowed[:, at:at + 11], at)
    for row in range(7):
        want = sorted((-scores[row, c], c) for c in np.flatnonzero(allowed[row]))[:5]
        mine = heaps.owner == row
        assert sorted(zip(-heaps.score[mine], heaps.place[mine])) == want


def test_too_long_a_vector_is_an_error(spark):
    with pytest.raises(Exception, match="too long"):
        negatives.hard_negatives(spark.createDataFrame([(100, [1e9] * 4, 1)], EMBEDDINGS))


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], EMBEDDINGS)
    assert negatives.hard_negatives(none).count() == 0
    df = spark.createDataFrame(rows(150, 5), EMBEDDINGS)
    more = df.select("*", *(F.lit(1).alias(c) for c in ("uid", "v", "score", "slot", "anchor", "none", "rank")))
    assert bag(negatives.hard_negatives(more)) == bag(negatives.hard_negatives(df))

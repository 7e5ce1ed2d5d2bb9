"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from llm.examples import awkward, bag, words

from ledgermill.llm import graph, simhash


def plain(text, k=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    grams = [parts] if len(parts) < k else [parts[i:i + k] for i in range(len(parts) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, radius=4):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                a_, b_ = sorted((find(i), find(j)))
                label[b_] = a_
    return [find(k) for k in range(len(prints))]


def near(value, rng, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def some_prints(seed, centres=30, copies=25):
    rng = random.Random(seed)
    out = []
    for _ in range(centres):
        value = rng.getrandbits(64)
        for _ in range(copies):
            value = near(value, rng, rng.choice([0, 1, 2, 3, 4, 5, 6, 9]))
            out.append(value)
    return sorted(set(out))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_are_the_plain_ones():
    texts = [r[1] for r in awkward() if r[1] is None or len(r[1]) < 5000] + [words(random.Random(1), 600)]
    for text in texts:
        assert int.from_bytes(simhash.fingerprint(text), "big") == plain(text)


def test_fingerprint_of_many_shingles_in_blocks(monkeypatch):
    text = words(random.Random(2), 2000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 300)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("entries", [10, 10**6, 10**8, 10**10])
def test_a_key_survives_any_changed_bits(entries):
    masks, rng = simhash.masks(entries), random.Random(3)
    for _ in range(300):
        change = near(0, rng, 4)
        assert any(m & change == 0 for m in masks)


@pytest.mark.parametrize("slice_rows", [2048, 5])
def test_links_span_what_all_pairs_span(spark, slice_rows):
    prints = some_prints(4)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    found = {r["node"]: r["root"] for r in graph.components(simhash.links(df, 4, slice_rows)).collect()}
    want = brute(prints)
    groups = {}
    for x, label in zip(prints, want):
        groups.setdefault(label, set()).add(signed(x))
    ours = {}
    for x in prints:
        ours.setdefault(found.get(signed(x), signed(x)), set()).add(signed(x))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))
    assert all(root == min(group) for root, group in ours.items())


def test_rest_of_a_key_survives_too():
    rng = random.Random(9)
    for mask in simhash.masks(10**8):
        rest = simhash.rest_masks(mask)
        assert sum(rest) == (1 << 64) - 1 - mask
        for _ in range(20):
            change = near(0, rng, 4)
            assert mask & change or any(m & change == 0 for m in rest)


def test_a_hot_group_makes_no_more_edges_than_nodes():
    rng = random.Random(6)
    fp = np.array(sorted({near(1 << 60, rng, 2) for _ in range(600)}), np.uint64)
    fp = fp[np.argsort(np.bitwise_count(fp ^ simhash.PIVOTS[0]), kind="stable")]
    a, b = simhash.forest(fp, np.zeros(len(fp), np.int64), 4)
    assert len(a) == len(fp) - 1
    assert max(np.unique(np.concatenate((a, b)), return_counts=True)[1]) <= 3


def test_pivots_discard_only_pairs_that_differ_more():
    rng = np.random.default_rng(7)
    fp = rng.integers(0, 1 << 64, 400, np.uint64, endpoint=False)
    table = np.array([np.bitwise_count(fp ^ p).astype(int) for p in simhash.PIVOTS])
    apart = np.abs(table[:, :, None] - table[:, None, :]).max(axis=0)
    assert (apart <= np.bitwise_count(fp[:, None] ^ fp[None, :])).all()
    assert (apart <= 4).sum() - len(fp) < 20


def test_components_match_all_pairs(spark, docs):
    rows = docs.collect()
    prints = [plain(r["text"]) for r in rows]
    label = brute(prints)
    least = {}
    for r, x in zip(rows, label):
        if r["doc_id"] is not None:
            least[x] = min(least.get(x, r["doc_id"]), r["doc_id"])
    want = sorted(repr((r["doc_id"], f"{p:016x}", least.get(x))) for r, p, x in zip(rows, prints, label))
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(repr(tuple(r)) for r in found) == want


def test_keep_one_keeps_the_smallest_id_of_each_group(docs, clashing, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(3) == 1 and 4 in ids and 5 not in ids and None not in ids and 1 in ids and 2 not in ids
    assert len(set(ids)) == len(ids)
    assert bag(simhash.keep_one(clashing), *docs.columns) == bag(kept)
    assert simhash.keep_one(none).count() == 0


def test_groups_without_any_id_stay_apart(spark):
    rng = random.Random(8)
    a, b = words(rng, 40), words(rng, 40)
    df = spark.createDataFrame([(None, a), (None, a), (None, b)], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(df).collect()) == sorted([a, b])
    assert [r["component_id"] for r in simhash.near_duplicates(df).collect()] == [None] * 3


def test_empty_and_clashing(docs, clashing, none):
    assert simhash.near_duplicates(none).count() == 0
    assert bag(simhash.near_duplicates(clashing)) == bag(simhash.near_duplicates(docs))


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[k] for k in range(51)} == {0}
    assert {found[k] for k in range(100, 160)} == {100} and found[201] == 200
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_crowded_cells_are_cut_finer_and_lose_nothing(spark):
    """All entries share one block of bits, and some of them lie close together."""
    rng = random.Random(11)
    prints = sorted({(near(x, rng, 2) & ~0x1FFF) | 5 for x in some_prints(12, 40, 30)})
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    found = {r["node"]: r["root"] for r in graph.components(simhash.links(df, 4, 20)).collect()}
    want = {}
    for x, label in zip(prints, brute(prints)):
        want.setdefault(label, []).append(signed(x))
    lowest = {x: min(group) for group in want.values() for x in group}
    assert {x: found.get(x, x) for x in lowest} == lowest

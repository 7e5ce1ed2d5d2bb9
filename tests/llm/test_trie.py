"""The conversation trie against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from llm.examples import bag
from pyspark.sql import functions as F

from ledgermill.llm import trie

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def name(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(b"turn%d " % len(role) + role + text).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, name(role, text)[:16], (role or "", text or "")))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for seq in members:
        if seq:
            children.setdefault(seq[:-1], []).append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        below = children.get(seq, [])
        leaves[seq] = sum(leaves[x] for x in below) or 1
        words = len(WORD.findall(seq[-1][1])) if seq else 0
        saved[seq] = sum(saved[x] for x in below) + (len(members[seq]) - 1) * words
    out = []
    for seq, cs in members.items():
        ended = ",".join(str(c) for c in sorted(cs) if len(full[c]) == len(seq))
        out.append(repr((min(cs), len(seq), min(members[seq[:-1]]) if seq else None, len(cs), len(children.get(seq, [])),
                         leaves[seq], saved[seq], hashlib.sha256(ended.encode()).hexdigest())))
    return sorted(out)


def found(df):
    return sorted(repr(tuple(r)) for r in trie.prefix_trie(df).collect())


def conversations(seed, n=70, longest=9):
    """Few different turns, so many prefixes are shared; some families lack their first one."""
    rng, out = random.Random(seed), []
    for c in rng.sample(range(-40, 160), n):
        out += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d e f"]))
                for t in range(rng.randint(1, longest))]
    return out


AWKWARD = [
    (None, 0, "user", "no conversation"), (0, None, "user", None), (0, None, None, "x y"), (0, 1, "user", ""),
    (0, 1, "user", ""), (0, 1, "assistant", "same turn"), (1, 5, "user", "é ß\n\tΣ"), (1, 5, "user", "é ß\n\tΣ"),
    (3, -1, "user", "before"), (3, 0, "user", "word " * 30_000), (25, 0, "user", "its first one is absent"),
    (47, 3, None, None),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows = conversations(seed)
    assert found(spark.createDataFrame(rows, TURNS).repartition(3)) == brute(rows)


def test_nulls_ties_repeats_and_absent_first_ones(spark):
    assert found(spark.createDataFrame(AWKWARD, TURNS)) == brute(AWKWARD)


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    one = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(one, 0, "user", "gone"), (one, 1, "user", "too")]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)
    assert trie.prefix_trie(spark.createDataFrame(rows, TURNS)).count() == 1


def test_a_long_conversation_and_its_copies(spark):
    rng = random.Random(3)
    long = [rng.choice(["a", "b c"]) for _ in range(130)]
    rows = [(c, t, "user", x) for c in (40, 60, 80) for t, x in enumerate(long[:130 - (c - 40) // 10])]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)


def test_a_hot_node_is_hashed_from_many_pieces(spark, monkeypatch):
    rows = [(20 * c, 0, "user", "all the same") for c in range(400)]
    rows += [(20 * c + 1, t, "user", f"{c % 3}") for c in range(60) for t in range(5)]
    df = spark.createDataFrame(rows, TURNS)
    monkeypatch.setattr(trie, "PIECE", 20)
    named, lengths = trie.rebuilt(df)
    every = trie.prefixes(named, lengths, 3)
    hot = every.filter("depth = 1").groupBy("name").count().agg(F.max("count")).first()[0]
    assert hot >= 400 and found(df) == brute(rows)


def test_empty_and_clashing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    df = spark.createDataFrame(conversations(4, 20), TURNS)
    more = df.select("*", *(F.lit(1).alias(x) for x in ("c", "rank", "name", "words", "depth", "parent", "first")))
    assert bag(trie.prefix_trie(more)) == bag(trie.prefix_trie(df))

"""Training order: a permutation, files with a fixed stride, resumable reads."""

import zlib

import numpy as np
import pytest

from ledgermill.llm import order
from ledgermill.workspace import new_path


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_and_inverse(n):
    numbers = np.arange(n)
    slots = order.permute(numbers, n)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert np.array_equal(order.permute(slots, n, inverse=True), numbers)
    if n > 60:
        assert abs(np.corrcoef(slots, numbers)[0, 1]) < 0.3
        assert not np.array_equal(order.permute(numbers, n, key=1), slots)


def test_large_range():
    numbers = np.arange(10**12, 10**12 + 1000)
    slots = order.permute(numbers, 3 * 10**12)
    assert len(set(slots.tolist())) == 1000 and slots.max() < 3 * 10**12


def lines(docs, length):
    coder, end = order._coder(order.default_vocabulary())
    out = []
    for r in docs.collect():
        ids = [*coder.encode_ordinary(r["text"] or ""), end]
        for part, at in enumerate(range(0, len(ids), length)):
            got = ids[at:at + length]
            out.append((r["doc_id"], part, len(got), got + [end] * (length - len(got))))
    return out


def test_files_hold_every_sequence_at_its_slot(spark, docs):
    folder = new_path(spark, "order-test")
    placed = order.materialise(docs, folder, length=16, per_shard=1000).collect()
    n = len(placed)
    assert sorted(r["slot"] for r in placed) == list(range(n))
    assert order.manifest(folder)["sequences"] == n
    read = order.read_from(folder, 0, n + 5)
    assert len(read) == n
    got = sorted(repr((r["doc_id"], r["part"], r["n_tokens"], read[r["slot"]].tolist())) for r in placed)
    assert got == sorted(map(repr, lines(docs, 16)))
    assert [x.tolist() for x in order.read_from(folder, 995, 10)] == [x.tolist() for x in read[995:1005]]


def test_rows_of_the_query(docs, none, clashing):
    rows = order.training_order(docs, 16, 1000).collect()
    want = sorted(repr((i, p, n, zlib.crc32(np.array(x, "<u2").tobytes()))) for i, p, n, x in lines(docs, 16))
    assert sorted(repr((r["doc_id"], r["part"], r["n_tokens"], r["record_crc32"])) for r in rows) == want
    assert all(r["shard"] == r["slot"] // 1000 and r["byte_offset"] == r["slot"] % 1000 * 32 for r in rows)
    assert order.training_order(none).count() == 0
    assert order.training_order(clashing, 16, 1000).count() == len(rows)


def test_a_vocabulary_of_more_than_16_bits(spark, tmp_path):
    """70,000 tokens: records take four bytes a token, and say so."""
    import base64

    ranks = [bytes([b]) for b in range(256)]
    ranks += [bytes([a, b]) for a in range(256) for b in range(256)]
    ranks += [b"aaa" + bytes([97 + k % 26, 97 + k // 26 % 26, 97 + k // 676]) for k in range(70_000 - len(ranks))]
    path = tmp_path / "large.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(x) + b" %d\n" % k for k, x in enumerate(ranks)))
    folder = new_path(spark, "order-test")
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "zz zz")], "doc_id long, text string")
    placed = order.materialise(docs, folder, length=8, per_shard=2, vocabulary=str(path))
    assert order.manifest(folder)["bytes_per_token"] == 4
    records = order.read_from(folder, 0, 10)
    coder, end = order._coder(str(path))
    assert end == 70_000
    want = {r["slot"]: r["doc_id"] for r in placed.collect()}
    text = {1: "some text", 2: "", 3: "zz zz"}
    for slot, doc in want.items():
        assert records[slot].tolist() == ([*coder.encode_ordinary(text[doc])] + [end] * 8)[:8]

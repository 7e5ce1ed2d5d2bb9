"""The encoder against the tokenizers library, and round trips."""

import hashlib
import random
import struct

import pytest
from llm.examples import awkward, bag
from tokenizers import Tokenizer

from ledgermill.llm import bpe


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(bpe.default_vocabulary())
    out.no_truncation()
    out.no_padding()
    return out


def texts():
    rng = random.Random(1)
    pool = "abcdefgABC'!? \n\t éÉßΣ日12<|>😀́ᅠ가　\x1f\x85"
    fixed = ["", " ", "don't WON'T I'll'd !'s '' 'S", "ΟΔΟΣ Σ σς", "<|endoftext|>abc<|startoftext|> x <|end",
             "école ẛ̣ ﬁ", "日本語 テキスト 123456 ١٢٣", "a\x1cb\x85c d", "😀👍🏽 x'reads", "İstanbul", "aaaaaaaaaaaa" * 40]
    return fixed + ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(500)]


def test_same_as_the_library(library):
    coder = bpe.Encoder(bpe.default_vocabulary())
    all_texts = texts() + [r[1] for r in awkward() if r[1]]
    for text, want in zip(all_texts, library.encode_batch(all_texts, add_special_tokens=False)):
        ids, decoded, n = coder.encode(text)
        assert list(struct.unpack(f"<{n}I", ids)) == want.ids, text[:80]
        assert decoded.decode() == coder.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_a_full_cache_changes_nothing(monkeypatch):
    whole = [bpe.Encoder(bpe.default_vocabulary()).encode(t) for t in texts()]
    monkeypatch.setattr(bpe, "CACHE", 3)
    small = bpe.Encoder(bpe.default_vocabulary())
    assert [small.encode(t) for t in texts()] == whole


def test_digests(docs, clashing, none, library):
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append(repr((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                          hashlib.sha256(text.encode()).hexdigest())))
    assert sorted(repr(tuple(r)) for r in bpe.digests(docs).collect()) == sorted(want)
    assert bag(bpe.digests(clashing)) == bag(bpe.digests(docs))
    assert bpe.digests(none).count() == 0


def test_encode_gives_the_ids(docs):
    coder = bpe.Encoder(bpe.default_vocabulary())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.encode(docs.filter("doc_id > 3")).collect():
        assert bytes(r["ids"]) == coder.encode(text[r["doc_id"]])[0] and len(r["ids"]) == 4 * r["n_tokens"]

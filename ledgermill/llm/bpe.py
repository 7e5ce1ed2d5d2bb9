"""Byte-pair encoding of whole texts with a public vocabulary, and decoding.

A piece's symbols form a doubly linked list. A priority queue holds the rank and place of every
neighbouring pair that has a merge; the lowest rank, leftmost first, is merged, its neighbours'
new pairs are queued, and entries whose pair is gone by then are skipped. Decoding concatenates
the vocabulary's strings, with a space between tokens as the vocabulary defines no decoder.

Texts repeat words, so every Python worker keeps the ids and decoded strings of the words and
pieces it has met, up to ``CACHE`` of either; what isn't there is encoded, whatever the size of
the corpus.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import arrow, fresh, shared_copy

#: Words and pieces that a worker keeps, some 80 MB of them.
CACHE = 200_000
#: Widths of a token id and of a place in a piece.
_ID_BITS, _PLACE_BITS = 24, 40
_PLACE = (1 << _PLACE_BITS) - 1
#: White space to Python's ``split`` but not to Unicode's White_Space.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


def default_vocabulary() -> str:
    """Where the public 49k vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary's strings.

    Printable Latin-1 bytes stand for themselves, the rest take the code points from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Encoder:
    """Encodes as the vocabulary file's normaliser, splitter and merges say."""

    def __init__(self, path: str):
        spec = json.loads(files.content(path))
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s.encode() for s, i in [*self.ids.items(), *self.special.items()]}
        self.suffix = model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Rank of a pair of ids, which make one number, and the id that each rank gives.
        self.ranks = {
            self.ids[a] << _ID_BITS | self.ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.ids[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.final = [self.ids[c + self.suffix] for c in letters]
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, tuple[bytes, bytes, int]] = {}
        self.known_pieces: dict[str, tuple[bytes, bytes, int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        inner, rank_of, merged = self.inner, self.ranks.get, self.merged
        symbols = [inner[b] for b in piece]
        symbols[-1] = self.final[piece[-1]]
        n = len(symbols)
        # A queue entry is one number: the pair's rank, then its place.
        queue = []
        for at in range(n - 1):
            rank = rank_of(symbols[at] << _ID_BITS | symbols[at + 1])
            if rank is not None:
                queue.append(rank << _PLACE_BITS | at)
        if not queue:
            return symbols
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            at, rank = entry & _PLACE, entry >> _PLACE_BITS
            follower = after[at]
            if symbols[at] < 0 or follower == n:
                continue
            if rank_of(symbols[at] << _ID_BITS | symbols[follower]) != rank:
                continue  # stale: one of the two has been merged since
            symbols[at] = new = merged[rank]
            symbols[follower] = -1
            after[at] = last = after[follower]
            if last < n:
                before[last] = at
                rank = rank_of(new << _ID_BITS | symbols[last])
                if rank is not None:
                    heapq.heappush(queue, rank << _PLACE_BITS | at)
            first = before[at]
            if first >= 0:
                rank = rank_of(symbols[first] << _ID_BITS | new)
                if rank is not None:
                    heapq.heappush(queue, rank << _PLACE_BITS | first)
        return [s for s in symbols if s >= 0]

    def piece(self, piece: str) -> tuple[bytes, bytes, int]:
        """One piece: its ids' bytes, its decoded bytes, its number of tokens."""
        found = self.known_pieces.get(piece)
        if found is None:
            ids = self.merge(piece.encode())
            strings = self.strings
            found = (struct.pack(f"<{len(ids)}I", *ids), b" ".join([strings[i] for i in ids]), len(ids))
            if len(self.known_pieces) >= CACHE:
                self.known_pieces.clear()
            self.known_pieces[piece] = found
        return found

    def word(self, word: str) -> tuple[bytes, bytes, int]:
        """The same for a run without white space."""
        text = word if word.isascii() else unicodedata.normalize("NFC", word)
        # Letter by letter: a final sigma is lower-cased like any other.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        if text.isalpha():
            return self.piece(text)
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            parts = [self.piece(text[:-1]), self.piece(text[-1])]
        else:
            parts = [self.piece(p) for p in self.pieces.findall(text)]
        if len(parts) == 1:
            return parts[0]
        return (b"".join([p[0] for p in parts]), b" ".join([p[1] for p in parts]),
                sum([p[2] for p in parts]))

    def runs(self, text: str) -> list[tuple[bytes, bytes, int]]:
        """What ``word`` gives for every run of a text without special tokens."""
        words = _SPACE.split(text) if _SEPARATORS.search(text) else text.split()
        known, out = self.known, []
        for word in words:
            found = known.get(word)
            if found is None:
                if not word:
                    continue
                found = self.word(word)
                if len(known) >= CACHE:
                    known.clear()
                known[word] = found
            out.append(found)
        return out

    def encode(self, text: str | None) -> tuple[bytes, bytes, int]:
        """Ids as little-endian 32-bit integers, the text decoded from them, the number of tokens."""
        text = text or ""
        if self.split is None or "<|" not in text:
            found = self.runs(text)
        else:
            found, at = [], 0
            for m in self.split.finditer(text):
                found += self.runs(text[at:m.start()])
                found.append((struct.pack("<I", self.special[m[0]]), m[0].encode(), 1))
                at = m.end()
            found += self.runs(text[at:])
        ids = b"".join([x[0] for x in found])
        return ids, b" ".join([x[1] for x in found if x[2]]), len(ids) // 4

    def decode(self, ids: bytes) -> str:
        """The text that ids stand for; ``encode`` puts together the same, word by word."""
        return b" ".join([self.strings[i] for (i,) in struct.iter_unpack("<I", ids)]).decode()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(path)


def mapped(docs: DataFrame, carry: list[str], schema: str,
           row: Callable[[tuple[bytes, bytes, int]], tuple], vocabulary: str) -> DataFrame:
    """``carry`` and the columns of ``schema``, which ``row`` makes of each encoded text."""
    text = fresh(docs, "text_")
    kept = docs.select(*carry, F.col("text").cast("string").alias(text))
    vocabulary = shared_copy(docs.sparkSession, vocabulary)
    made = docs.sparkSession.createDataFrame([], schema).schema
    out = docs.select(*carry).schema
    for field in made:
        out = out.add(field)
    kinds = [pa.int64() if f.dataType.typeName() == "long" else pa.binary()
             if f.dataType.typeName() == "binary" else pa.string() for f in made]
    names = [*carry, *made.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            found = [row(coder.encode(x.as_py())) for x in batch.column(batch.num_columns - 1)]
            columns = list(zip(*found)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)

    return kept.transform(arrow, run, out)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of every row.

    Null text counts as empty and has no tokens. Special tokens that occur in a text are their own
    ids. Rows are independent: repeated and null ids come out as they came in, other columns are
    not read, an empty table gives an empty one.
    """
    return mapped(docs, ["doc_id"], "n_tokens long, ids binary", lambda x: (x[2], x[0]),
                  vocabulary or default_vocabulary())


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and SHA-256 of the ids and of the text decoded from them.

    Null and empty texts have no tokens and the digests of nothing. A very long text is encoded
    whole, word by word. Rows are independent: repeated and null ids come out as they came in,
    other columns are not read, an empty table gives an empty one.
    """

    def row(found: tuple[bytes, bytes, int]) -> tuple:
        ids, decoded, n = found
        return n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return mapped(docs, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", row,
                  vocabulary or default_vocabulary())

"""Example documents, and a way to compare frames."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHES = ["size", "uid", "fp", "key", "slot", "kept", "anchor_file", "anchor_row", "mix_size", "mix_n",
           "text_", "normal_text", "chunks", "words", "t", "number", "component_id", "start", "range"]


def words(rng: random.Random, n: int, alphabet: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = words(rng, 30_000)
    base = words(rng, 60)
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", 0), (None, "The same text", "en", "b", 1),
        (None, "the SAME text", None, "b", None), (3, "The same text", "en", None, 1),
        (3, "The same text", "en", None, 1), (4, long, "de", "c", 1), (5, long.upper(), "de", "c", 1),
        (6, " \t\n ", None, None, None), (7, "12 34 !! 56", "en", "a", 3), (8, "É é ß Σίσυφος", "el", "é", 2),
        (9, "one two three", "en", "b", 3), (10, "ONE TWO THREE", "en", "b", 3), (11, "É É", "fr", "a", 1),
        (12, "é é", "fr", "a", 1), (-13, base, "en", "a", 1), (14, base + " x", "en", "a", 1),
    ]
    return rows + [(100 + k, words(rng, rng.randint(1, 50)), "en" if k % 2 else "de", "abc"[k % 3], k)
                   for k in range(40)]


def bag(df, *columns):
    return sorted(map(repr, (df.select(*columns) if columns else df).collect()))

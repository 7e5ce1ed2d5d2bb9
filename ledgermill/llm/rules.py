"""Quality rules: a table of thresholds, compiled into one Spark projection."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANK, WORD, computed, let

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "nicht", "ein",
    "le", "la", "les", "et", "des", "en", "un", "une", "que", "est", "pour", "dans", "qui",
    "el", "los", "de", "y", "por", "con", "una", "del", "se", "las", "para",
]


class Rule(NamedTuple):
    """``numerator`` / ``denominator`` of the measures must lie from ``least`` to ``most``."""

    name: str
    numerator: str
    denominator: str | None
    least: float | None
    most: float | None


#: Ratios over a denominator of zero pass: there is nothing to judge.
BASE = [
    Rule("length", "n_words", None, 20, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.30),
]
VERDICT = [
    Rule("word_length", "word_chars", "n_words", 2, 15),
    Rule("symbols", "n_symbols", "n_words", None, 0.10),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.50),
]


def passes(rule: Rule) -> Column:
    """A rule as a comparison of whole numbers; limits count in hundredths."""
    top = F.col(rule.numerator) * 100
    below = F.lit(1) if rule.denominator is None else F.col(rule.denominator)
    tests = [top >= below * round(rule.least * 100)] if rule.least is not None else []
    tests += [top <= below * round(rule.most * 100)] if rule.most is not None else []
    return reduce(Column.__and__, tests)


def _repeated(words: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that occur twice or more.

    Windows are compared as hashes of their words' hashes, first for whether any occurs twice,
    which settles most texts. Else they are sorted with their places, and the places of those
    equal to a neighbour add up as intervals.
    """

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(places)), F.lit(0),
            lambda total, k: total + F.least(
                F.lit(WINDOW),
                F.when(k < F.size(places), F.element_at(places, k + 1) - F.element_at(places, k))
                .otherwise(WINDOW)))

    def twice(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (
                ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.get(s, i + 1)["h"] == x["h"]))),
            lambda x: x["i"])))

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(twice(hashes), covered))

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    counted = let(F.transform(words, lambda w: F.xxhash64(w)), lambda w: let(windows(w), of))
    return F.when(F.size(words) < WINDOW, 0).otherwise(counted)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What the rules look at; ``text`` isn't null."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    blanks = F.regexp_count(text, F.lit(BLANK))
    found = {
        "n_words": F.size(words),
        "word_chars": F.char_length(text) - blanks,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_stop_words": F.regexp_count(
            text, F.lit(r"(?i)(?<![^\x20\x09-\x0D])(?:" + "|".join(dict.fromkeys(STOP_WORDS))
                        + r")(?![^\x20\x09-\x0D.,])")),
        "n_repeat_words": _repeated(words),
    }
    return {name: value.cast("long") for name, value in found.items()}


def judge(docs: DataFrame, base: list[Rule] = BASE, verdict: list[Rule] = VERDICT) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every row.

    Null text counts as empty: no words, all measures 0, ``base_failed``. Words are runs of
    anything but ASCII blanks; a symbol is a character of ``[#*$%&|<>]``; a repeated line is a
    line with a word that equals an earlier one. Rows are independent, so null and repeated ids
    come out as they came in; an empty table gives an empty one; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = computed(docs.select("doc_id", text.alias("text")), ["doc_id", "text"],
                    words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    found = computed(rows, ["doc_id"], **measures(F.col("text"), F.col("words")))
    failed = ~reduce(Column.__and__, map(passes, base))
    good = reduce(Column.__and__, map(passes, verdict))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & good).alias("kept"), "n_lines", "n_stop_words")

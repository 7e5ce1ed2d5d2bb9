"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds
its letters: each is rotated by its place and they are multiplied. A text's vector bundles (adds)
those of its n-grams, a language's prototype bundles those of its learned texts, and a text takes
the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import arrow, fresh
from ledgermill.workspace import new_path

DIMENSIONS, GRAM, SEED = 1024, 3, 20
UNKNOWN = "und"
#: n-grams and texts that are worked on together; a longer text is alone.
_CHUNK, _TEXTS = 200_000, 128
#: n-gram vectors a worker keeps, one kilobyte each.
_KEPT = 1 << 15
#: Prototypes that a worker compares, and keeps, at a time; more are read block by block.
BLOCK = 1000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 16)
def _letter(code: int) -> np.ndarray:
    drawn = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, np.int8)
    return (drawn * 2 - 1).astype(np.int8)


def grams(text: str) -> np.ndarray:
    """The n-grams of a text as numbers; lower case, one space around and between words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    codes = np.concatenate(([32], np.where(letter, codes, 32), [32]))
    blank = codes == 32
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    n = len(codes) - GRAM + 1
    out = np.zeros(n, np.int64)
    for k in range(GRAM):
        out = out << 21 | codes[k:k + n]
    return out


class _Vectors:
    """Vectors of n-grams; those met before are kept, up to ``_KEPT`` of them."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.rows = np.empty((_KEPT, DIMENSIONS), np.int8)

    @staticmethod
    def bind(gram: int) -> np.ndarray:
        out = np.ones(DIMENSIONS, np.int8)
        for k in range(GRAM):
            out = out * np.roll(_letter(gram >> 21 * k & 0x1FFFFF), k)
        return out

    def of(self, grams: np.ndarray) -> np.ndarray:
        out = np.empty((len(grams), DIMENSIONS), np.int8)
        keys = grams.tolist()
        place = np.fromiter((self.at.get(g, -1) for g in keys), np.int64, len(keys))
        out[place >= 0] = self.rows[place[place >= 0]]
        for k in np.flatnonzero(place < 0).tolist():
            out[k] = self.bind(keys[k])
            if len(self.at) < _KEPT:
                self.rows[len(self.at)] = out[k]
                self.at[keys[k]] = len(self.at)
        return out


@lru_cache(maxsize=1)
def _vectors() -> _Vectors:
    return _Vectors()


def bundle(groups: list[int], found: list[np.ndarray], n: int) -> np.ndarray:
    """n rows: the sum of the n-gram vectors of each group's texts. Sums of integers, so exact."""
    total = np.zeros((n, DIMENSIONS), np.float64)
    keys, inverse = np.unique(np.concatenate(found), return_inverse=True)
    owner = np.repeat(groups, [len(g) for g in found])
    for at in range(0, len(keys), 4096):
        part = (inverse >= at) & (inverse < at + 4096)
        width = min(4096, len(keys) - at)
        counts = np.bincount(owner[part] * width + inverse[part] - at, minlength=n * width)
        total += (counts.reshape(n, width).astype(np.float32)
                  @ _vectors().of(keys[at:at + width]).astype(np.float32))
    return total


def _chunks(items: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts' n-grams in portions of at most ``_CHUNK`` of ``_TEXTS`` texts, or of one text."""
    names: list[int] = []
    found: list[np.ndarray] = []
    size = 0
    for name, g in items:
        if names and (size + len(g) > _CHUNK or len(names) == _TEXTS):
            yield names, found
            names, found, size = [], [], 0
        names.append(name)
        found.append(g)
        size += len(g)
    if names:
        yield names, found


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id isn't."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> str:
    """Where the languages' prototypes are: a table of (lang, v), one line for each language of the
    rows that have a language, id and text and aren't held out. Tasks add up their own texts; only
    sums are shuffled, and nothing is collected."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                       & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, codes = np.unique(
                np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            items = ((int(c), g) for c, x in zip(codes, batch.column(1)) if len(g := grams(x.as_py())))
            for groups, found in _chunks(items):
                part = bundle(groups, found, len(langs))
                for k in set(groups):
                    sums[langs[k]] = sums.get(langs[k], 0) + part[k]
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(x) for x in sums]),
                 pa.array([v.astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "v"])

    parts = rows.select(F.col("lang").cast("string"), F.col("text").cast("string")).transform(
        arrow, run, "lang string, v array<long>")
    total = (parts.select("lang", F.posexplode("v").alias("k", "x"))
             .groupBy("lang", "k").agg(F.sum("x").alias("x"))
             .groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))),
                                              lambda s: s["x"]).alias("v")))
    path = new_path(docs.sparkSession, "prototypes")
    total.write.parquet(path)
    return path


def _read_blocks(path: str, block: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages and unit prototypes, up to ``block`` at a time."""
    fs, folder = files.resolve(path)
    table = pads.dataset(folder, filesystem=fs, format="parquet")
    names: list[str] = []
    lines: list[np.ndarray] = []
    for batch in table.to_batches(batch_size=block, batch_readahead=1, fragment_readahead=1, use_threads=False):
        for at in range(0, batch.num_rows, block):
            part = batch.slice(at, block)
            if names and len(names) + part.num_rows > block:
                yield names, np.concatenate(lines)
                names, lines = [], []
            if part.num_rows:
                names += part.column("lang").to_pylist()
                v = part.column("v").flatten().to_numpy().astype(np.float64).reshape(-1, DIMENSIONS)
                lines.append(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1))
    if names:
        yield names, np.concatenate(lines)


@lru_cache(maxsize=2)
def _first_blocks(path: str, block: int) -> tuple[list, bool]:
    """The first block, if any, and whether it is the only one."""
    found = list(itertools.islice(_read_blocks(path, block), 2))
    return found[:1], len(found) < 2


def _blocks(path: str, block: int) -> Iterable[tuple[list[str], np.ndarray]]:
    """All blocks; a worker keeps a single one, several are read anew."""
    first, only = _first_blocks(path, block)
    return first if only else _read_blocks(path, block)


def predictor(path: str, block: int = BLOCK):
    """A function from a column of texts to (language, cosine) lists."""

    def predict(texts: pa.Array) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        items = ((k, g) for k, x in enumerate(texts) if len(g := grams(x.as_py() or "")))
        places: list[int] = []
        lines: list[np.ndarray] = []
        for chunk, found in _chunks(items):
            vectors = bundle(list(range(len(chunk))), found, len(chunk))
            places += chunk
            lines.append(vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1))
        if not places:
            return names, scores
        vectors, best = np.concatenate(lines), [None] * len(places)
        for langs, prototypes in _blocks(path, block):
            order = sorted(range(len(langs)), key=langs.__getitem__)
            cosine = (vectors @ prototypes.T)[:, order]
            for k, at in enumerate(cosine.argmax(axis=1)):
                new = (-float(cosine[k, at]), langs[order[at]])
                if best[k] is None or new < best[k]:
                    best[k] = new
        for place, found in zip(places, best):
            if found is not None:
                names[place], scores[place] = found[1], min(1.0, max(0.0, -found[0]))
        return names, scores

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (cosine, 0 to 1) of every row.

    Texts that are null or have no letter, and all texts where nothing could be learned, get
    ``und`` with score 0. Of equal cosines the first language by code point wins. Repeated rows
    come out as often as they came in and null ids as null; an empty table gives an empty one;
    other columns are not read.
    """
    predict = predictor(learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    schema = rows.select(
        "doc_id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.transform(arrow, run, schema)


def keep_known(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """``docs`` without texts whose language is ``und`` or whose cosine isn't above ``least``.

    Texts of letters that no learned language uses end at zero or below; a single short word of a
    language is above. Columns and their order stay. Null and empty texts have no letter and go;
    null ids, and repeated rows as often as they came, stay or go by their texts; an empty table
    gives an empty one.
    """
    predict = predictor(learn(docs))
    text = fresh(docs, "text_")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(batch.column(batch.num_columns - 1))
            keep = pa.array([n != UNKNOWN and s > least for n, s in zip(names, scores)], pa.bool_())
            yield batch.select(columns).filter(keep)

    rows = docs.select(*(F.col(f"`{c}`") for c in columns), F.col("text").cast("string").alias(text))
    return rows.transform(arrow, run, docs.schema)

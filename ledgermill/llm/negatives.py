"""Hard negatives by exact integer inner products.

Anchors meet all rows in tiles. A tile of scores is the product of an anchor tile and a candidate
tile, by Strassen's recursion on int64 matrices padded with zeros. A first pass keeps each anchor's
best rows of its own label, a second one, for each of these positives, the best rows of other
labels whose scores lie in the positive's window. Both are heaps of bounded size that merge: the
tiles of a task first, then all tasks.

Rows are dealt to tasks once. Anchors, a stated share of all rows, are a table in the shared folder
that every task reads tile by tile, so neither side is sent to all tasks or held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import arrow
from ledgermill.workspace import new_path, stage

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: The window of a positive's score p: LOW * p <= 100 * score <= HIGH * p.
LOW, HIGH = 30, 90
#: Rows of an anchor tile and of a candidate tile, and the side at which the recursion ends.
ANCHORS, CANDIDATES, LEAF = 512, 2048, 32
#: Rows that a task holds at a time, at least and at most, and their bytes at most.
LEAST, MOST, BYTES = 4096, 65_536, 64 << 20
_NONE = np.iinfo(np.int64).min


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A leaf: in doubles where every sum stays below 2^53 and so is exact, else in int64."""
    most = max(int(a.max(initial=0)), -int(a.min(initial=0))) * max(int(b.max(initial=0)), -int(b.min(initial=0)))
    if most * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _strassen(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return _product(a, b)
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = _strassen(a11 + a22, b11 + b22, leaf)
    p2 = _strassen(a21 + a22, b11, leaf)
    p3 = _strassen(a11, b12 - b22, leaf)
    p4 = _strassen(a22, b21 - b11, leaf)
    p5 = _strassen(a11 + a12, b22, leaf)
    p6 = _strassen(a21 - a11, b11 + b12, leaf)
    p7 = _strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:h, :j], out[:h, j:] = p1 + p4 - p5 + p7, p3 + p5
    out[h:, :j], out[h:, j:] = p2 + p4, p1 - p2 + p3 + p6
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2^64 and so exact wherever the results fit.

    Sides are padded with zeros to multiples of 2^levels, so that every cut is in half.
    """
    (m, k), n = a.shape, b.shape[1]
    if not min(m, k, n):
        return np.zeros((m, n), np.int64)
    levels = max(0, (-(-min(m, k, n) // leaf) - 1).bit_length())
    full = [-(-x >> levels) << levels for x in (m, k, n)]
    wide = np.zeros((full[0], full[1]), np.int64)
    wide[:m, :k] = a
    tall = np.zeros((full[1], full[2]), np.int64)
    tall[:k, :n] = b
    return _strassen(wide, tall, leaf)[:m, :n]


class Heaps:
    """For each of ``n`` owners the ``k`` best (score, place): higher scores, then lower places."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.owner = self.score = self.place = np.empty(0, np.int64)
        #: The k-th best score of each owner so far.
        self.least = np.full(n, _NONE)

    def merge(self, owner: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        """Take in entries of places that all come after those seen."""
        owner, score, place = (np.concatenate(x) for x in (
            (self.owner, owner), (self.score, score), (self.place, place)))
        order = np.lexsort((place, -score, owner))
        owner, score, place = owner[order], score[order], place[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept, last = rank < self.k, rank == self.k - 1
        self.owner, self.score, self.place = owner[kept], score[kept], place[kept]
        self.least[owner[last]] = score[last]

    def offer(self, scores: np.ndarray, allowed: np.ndarray, start: int, slot: int = 0, slots: int = 1) -> None:
        """Take in a tile; its rows are owners ``row * slots + slot``, its columns places from ``start``."""
        owners = np.arange(len(scores)) * slots + slot
        bound = self.least[owners]
        if scores.shape[1] > self.k:
            masked = np.where(allowed, scores, _NONE)
            kth = np.partition(masked, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            allowed = allowed & (scores >= kth[:, None])
        # Later places lose against an equal score, so only what is above counts.
        rows, columns = np.nonzero(allowed & (scores > bound[:, None]))
        if len(rows):
            self.merge(owners[rows], scores[rows, columns], columns + start)


def _matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of integers as lines, short ones padded with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    width = max(width, int(lengths.max(initial=0)))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _scores(a: pa.Array, b: pa.Array) -> np.ndarray:
    width = max((int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in (a, b)), default=0)
    return strassen(_matrix(a, width), _matrix(b, width).T)


def _longs(column: pa.Array, null: int) -> np.ndarray:
    return column.fill_null(null).to_numpy()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A task's rows, so many at a time, in the order in which equal scores come."""

    def chunk(parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts)
        return table.sort_by([("none", "ascending"), ("vec_id", "ascending"), ("uid", "ascending")]).combine_chunks()

    parts, rows, size = [], 0, 0
    for batch in batches:
        if parts and (rows + batch.num_rows > MOST or size + batch.nbytes > BYTES):
            yield chunk(parts)
            parts, rows, size = [], 0, 0
        parts.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if rows:
        yield chunk(parts)


def _anchor_tiles(path: str) -> Iterator[pa.RecordBatch]:
    fs, folder = files.resolve(path)
    table = pads.dataset(folder, filesystem=fs, format="parquet")
    for batch in table.to_batches(batch_size=ANCHORS, batch_readahead=1, fragment_readahead=1, use_threads=False):
        if batch.num_rows:
            yield batch


def vectors(embeddings: DataFrame, relabel: int = 7, labels: int = 10) -> DataFrame:
    """``uid``, ``vec_id``, ``label`` and the integers ``v`` of every row that takes part, written.

    Out are null labels, null vectors and those with a null or non-finite component. Every
    ``relabel``-th id gets the next label. A vector whose squared length does not fit a long is an
    error, as its scores might not either; for all others every inner product does.
    """
    x = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    shifted = F.when(F.col("vec_id") % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    whole = F.transform(x, lambda e: F.floor(e * 256))
    size = F.aggregate(x, F.lit(0.0), lambda s, e: s + F.pow(F.abs(e) * 256 + 1, F.lit(2.0)))
    fits = F.when(size < float(1 << 63), whole).otherwise(F.raise_error(F.lit("a vector is too long for 64-bit scores")))
    rows = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    return stage(rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
        shifted.cast("int").alias("label"), fits.cast("array<long>").alias("v")), "vectors")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in tasks of even size, as large as keeps all cores busy, up to ``MOST``."""
    n = rows.count()
    each = min(MOST, max(LEAST, n // (4 * rows.sparkSession.sparkContext.defaultParallelism)))
    return rows.select("uid", "vec_id", "label", "v", F.col("vec_id").isNull().alias("none")).repartition(
        max(1, -(-n // each)))


_FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()),
                    ("vec_id", pa.int64()), ("uid", pa.int64())])
_FOUND_SQL = "anchor long, slot int, score long, vec_id long, uid long"


def _found(heaps: Heaps, tile: pa.RecordBatch, chunk: pa.Table, slots: int) -> pa.RecordBatch:
    place = pa.array(heaps.place)
    return pa.RecordBatch.from_arrays(
        [tile.column("uid").take(pa.array(heaps.owner // slots)),
         pa.array((heaps.owner % slots).astype(np.int32)), pa.array(heaps.score),
         chunk.column("vec_id").combine_chunks().take(place), chunk.column("uid").combine_chunks().take(place)],
        schema=_FOUND)


def _mined(rows: DataFrame, anchors: str, slots: int, keep: int, offer) -> DataFrame:
    """What ``offer`` puts on the heaps of every anchor tile, one set of heaps a task and tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            label, uid = chunk.column("label").to_numpy(), chunk.column("uid").to_numpy()
            v = chunk.column("v").combine_chunks()
            for tile in _anchor_tiles(anchors):
                heaps = Heaps(tile.num_rows * slots, keep)
                for at in range(0, len(uid), CANDIDATES):
                    part = slice(at, at + CANDIDATES)
                    scores = _scores(tile.column("v"), v[part])
                    same = tile.column("label").to_numpy()[:, None] == label[part]
                    offer(heaps, tile, scores, same, uid[part], at)
                yield _found(heaps, tile, chunk, slots)

    return rows.transform(arrow, run, _FOUND_SQL)


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The tasks' heaps merged: the ``keep`` best of every (anchor, slot), with their ``rank``."""
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("uid"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _offer_positives(heaps, tile, scores, same, uid, at) -> None:
    heaps.offer(scores, same & (uid != tile.column("uid").to_numpy()[:, None]), at)


def _offer_window(heaps, tile, scores, same, uid, at) -> None:
    for slot in range(POSITIVES):
        low, high = (_longs(tile.column(f"{name}{slot}"), null)[:, None] for name, null in (("low", 0), ("high", -1)))
        heaps.offer(scores, ~same & (scores >= low) & (scores <= high), at, slot, POSITIVES)


def _bound(score: Column, share: int, up: bool) -> Column:
    """``share`` hundredths of a score, rounded up or down to a whole number."""
    exact = score.cast("decimal(20,0)") * share / 100
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``: of every anchor, for each of its positives, the first negatives.

    Anchors are rows whose ``vec_id`` is divisible by ``EVERY``; a null id is never one, but such a
    row is a candidate like any other and comes last among equal scores. Repeated rows are rows of
    their own: each is an anchor, and one may be the other's positive. Vectors of different lengths
    are compared as if the shorter went on with zeros; an empty one scores 0. An anchor without
    positives, or a positive with nothing in its window (such as one with a negative score), has no
    rows. An empty table gives an empty one; other columns are not read.
    """
    rows = vectors(embeddings.select("vec_id", "embedding", "label"))
    anchors = rows.filter(F.col("vec_id") % EVERY == 0)
    plain = new_path(rows.sparkSession, "anchors")
    anchors.write.parquet(plain)
    dealt = _dealt(rows)
    positives = stage(_best(_mined(dealt, plain, 1, POSITIVES, _offer_positives), POSITIVES).select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    limits = positives.groupBy(F.col("anchor").alias("uid")).agg(*(
        F.max(F.when(F.col("slot") == s, _bound(F.col("positive_score"), share, up))).alias(f"{name}{s}")
        for s in range(POSITIVES) for name, share, up in (("low", LOW, True), ("high", HIGH, False))))
    windows = new_path(rows.sparkSession, "windows")
    anchors.join(limits, "uid").write.parquet(windows)
    found = _best(_mined(dealt, windows, POSITIVES, NEGATIVES, _offer_window), NEGATIVES)
    return (found.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score")
            .join(positives, ["anchor", "slot"])
            .join(anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))

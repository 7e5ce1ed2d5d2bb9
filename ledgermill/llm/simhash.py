"""Near-duplicates by SimHash, with pivot distance tables in front of the comparison.

Every text gets a 64-bit fingerprint. Fingerprints link at ``radius`` or fewer differing bits.
Equal fingerprints are one entry from there on. The 64 bits are cut into blocks so that two
linked fingerprints agree in a whole set of blocks; entries meet in cells of such a set. In a
cell the distances of every entry to a fixed list of reference fingerprints (the pivots) are put
down first. By the triangle inequality a pair whose distances to any one pivot differ by more
than the radius cannot link: a cell is sorted by the first coordinate and walked in that window,
the other coordinates discard nearly all that is left, and only survivors are compared.

A cell with many entries is cut by the bits outside its key in the same way; one that still has
many, because its entries are near-copies of each other, is dealt out as cells of two slices each,
so no task holds a whole hot group. A cell gives only a spanning forest of its links, its members
tied like a binary heap, so that neither the edges nor a node's degree grow with the square of a
group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import anchored, arrow, fresh
from ledgermill.llm.graph import components
from ledgermill.workspace import stage

WORDS, RADIUS, SEED = 4, 4, 42
#: Reference fingerprints: hashes of their numbers.
PIVOTS = np.array([xxhash.xxh64_intdigest(b"pivot %d" % k) for k in range(32)], dtype=np.uint64)
#: Entries of one slice of a cell; a cell to compare holds two slices at most.
SLICE = 2048
#: Entries that a cell has on average, at most; more entries get longer keys.
CELL = 64
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> bytes:
    """Eight bytes, most significant bit first: the majority of the shingles' hashes.

    Only A-Z are lower-cased. Fewer words than a shingle has: the whole sequence is the one
    shingle. No word, or null: zero.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return bytes(8)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    if len(parts) <= words:
        begin, end = [0], [len(joined)]
    else:
        begin, end = starts[: len(parts) - words + 1], (starts + sizes)[words - 1:]
        begin, end = begin.tolist(), end.tolist()
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(begin), _BLOCK):
        part = b"".join([digest(joined[b:e], seed)
                         for b, e in zip(begin[at:at + _BLOCK], end[at:at + _BLOCK])])
        total += _ones(np.frombuffer(part, np.uint8))
    return np.packbits(2 * total > len(begin)).tobytes()


def _ones(digests: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set; sums of up to 255 rows fit a byte."""
    bits = np.unpackbits(digests).reshape(-1, 64)
    whole = len(bits) // 255 * 255
    out = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        out += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, carry: list[str], words: int = WORDS) -> DataFrame:
    """``carry`` and ``fp``, the fingerprint as a signed long, for every row."""
    kept = docs.select(*carry, F.col("text").cast("string").alias(text := fresh(docs, "text_")))
    schema = docs.select(*carry, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = b"".join(fingerprint(x.as_py(), words) for x in texts)
            values = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values)], names=[*carry, "fp"])

    return kept.transform(arrow, run, schema)


def masks(entries: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of which one at least is untouched by any ``radius`` changed bits.

    64 bits are cut into m blocks and m - radius of them make a key, every choice once. m is the
    smallest for which a key's cell holds ``CELL`` entries on average.
    """
    m = radius + 1
    while m < 2 * radius + 4 and entries > CELL * 2 ** (64 * (m - radius) // m):
        m += 1
    cuts = [64 * k // m for k in range(m + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(chosen) for chosen in itertools.combinations(blocks, m - radius)]


def rest_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """The bits outside a mask in radius + 1 parts, one of which no ``radius`` changes touch."""
    bits = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(bits) * k // (radius + 1) for k in range(radius + 2)]
    return [sum(1 << b for b in bits[x:y]) for x, y in itertools.pairwise(cuts)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys_of(chosen: list[int]) -> Column:
    """What is left of a fingerprint under each mask."""
    return F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in chosen))


def links(entries: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """Edges (a, b) of a spanning forest of all links among the distinct longs in ``fp``."""
    keys = masks(entries.count(), radius)
    found = entries.select("fp", F.posexplode(_keys_of(keys)).alias("t", "key"))
    crowded = stage(
        found.groupBy("t", "key").count().filter(F.col("count") > slice_rows)
        .select("t", "key", F.lit(True).alias("crowded")), "crowded")
    # Within a crowded cell the other bits make keys in the same way; pairs that link agree in one.
    rest = F.array(*(_keys_of(rest_masks(m, radius)) for m in keys))
    finer = F.when(F.col("crowded"), F.element_at(rest, F.col("t") + 1)).otherwise(
        F.array(F.lit(0).cast("long")))

    def split(rows: DataFrame) -> DataFrame:
        return rows.select("fp", "t", "key", F.posexplode(finer).alias("u", "key2"))

    cell = ["t", "key", "u", "key2"]
    still = stage(
        split(found.join(crowded, ["t", "key"])).groupBy(*cell).count()
        .filter(F.col("count") > slice_rows)
        .select(*cell, F.ceil(F.col("count") / slice_rows).cast("int").alias("slices")), "sliced")
    slices = F.coalesce("slices", F.lit(1))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), slices).cast("int")
    cells = (
        split(found.join(crowded, ["t", "key"], "left")).join(still, cell, "left")
        .select("fp", *cell, own.alias("own"),
                F.explode(F.sequence(F.lit(0), slices - 1)).alias("other"))
        .select("fp", *cell, F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"),
                F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(int(PIVOTS[0]))).cast("long")))
                .cast("int").alias("first")))
    order = [*cell, "i", "j"]
    dealt = cells.repartition(*order).sortWithinPartitions(*order, "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:1 + len(order)]]
                rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            if rest is None or not len(rest[0]):
                continue
            cell = np.concatenate(([0], np.cumsum(
                np.any([x[1:] != x[:-1] for x in rest[1:]], axis=0))))
            done = len(cell) if batch is None else int(np.searchsorted(cell, cell[-1]))
            if done:
                a, b = forest(rest[0][:done].view(np.uint64), cell[:done], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                rest = [x[done:] for x in rest]

    return dealt.transform(arrow, run, "a long, b long")


def forest(fp: np.ndarray, cell: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links in each cell. Rows come by cell and first pivot distance."""
    table = [np.bitwise_count(fp ^ p).astype(np.int8) for p in PIVOTS]
    label = np.arange(len(fp))
    active, step = np.arange(len(fp) - 1), 1
    while len(active):
        active = active[active + step < len(fp)]
        there = active + step
        near = (cell[there] == cell[active]) & (table[0][there] - table[0][active] <= radius)
        active = active[near]
        i, j = active, active + step
        new = label[i] != label[j]
        i, j = i[new], j[new]
        for coordinate in table[1:]:
            if not len(i):
                break
            near = np.abs(coordinate[i] - coordinate[j]) <= radius
            i, j = i[near], j[near]
        true = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        i, j = i[true], j[true]
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label = up
        step += 1
    grouped = np.bincount(label, minlength=len(label))[label] > 1
    value, label = fp[grouped].view(np.int64), label[grouped]
    order = np.lexsort((value, label))
    value, label = value[order], label[order]
    first = np.searchsorted(label, label)
    place = np.arange(len(label)) - first
    child = place > 0
    parent = first + (place - 1) // 2
    return value[child], value[parent[child]]


def _grouped(
    docs: DataFrame, carry: list[str], words: int, radius: int
) -> tuple[DataFrame, DataFrame]:
    """(carry, fp) of every row, and (fp, root, component_id) of every fingerprint; both written."""
    marked = stage(fingerprints(docs, carry, words), "fingerprints")
    entries = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "entries")
    label = components(links(entries.select("fp"), radius))
    linked = stage(entries.join(label.withColumnRenamed("node", "fp"), "fp"), "linked")
    lowest = stage(linked.groupBy("root").agg(F.min("first").alias("lowest")), "lowest")
    known = stage(linked.join(lowest, "root").select("fp", "root", "lowest"), "known")
    return marked, stage(entries.join(known, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("lowest", "first").alias("component_id")), "ids")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included. Null
    text counts as no words; texts without words share fingerprint zero, which links like any
    other. A null ``doc_id`` is passed over for a component's smallest; where all are null, so is
    the component's. Repeated rows come out as often as they came in; an empty table gives an
    empty one; other columns are not read.
    """
    marked, ids = _grouped(docs, ["doc_id"], words, radius)
    return marked.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the smallest doc_id, nulls last, then file order.

    Texts without words, null and empty ones included, share fingerprint zero and are one group
    with whatever links to it. Of repeated rows one stays. Columns and their order stay; an empty
    table gives an empty one.
    """
    rows, anchor = anchored(docs)
    marked, ids = _grouped(rows, ["doc_id", *anchor], words, radius)
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", *anchor)
    found = stage(marked.join(ids, "fp").select("root", key.alias("key"), *anchor), "groups")
    least = stage(found.groupBy("root").agg(F.min("key").alias("least")), "least")
    dropped = stage(found.join(least, "root").filter("key != least").select(*anchor), "dropped")
    return rows.join(dropped, anchor, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))

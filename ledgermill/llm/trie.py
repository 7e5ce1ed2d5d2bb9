"""A trie of conversation prefixes, built by van Emde Boas recursion.

A trie of height 2^k is cut at half its height into an upper trie and a forest of lower tries, one
below each distinct cut prefix, and each of these again. All pieces of one height are worked on
together, as rows of one table, so a recursion of log2(height) levels takes conversations of any
length. On the way down the cut prefixes are named: a prefix that ends at an odd multiple of 2^k is
the prefix 2^k turns shorter, whose name a taller level has given, and a block of 2^k turns. On the
way up, totals are grafted: when two heights become one, each lower trie's total at its root is
added to all nodes of the upper trie above it.

Names are digests of what they stand for, so equal prefixes meet by name without being compared.
No step needs a conversation, a node's members or a depth in one task: turns are placed by ranges,
blocks and prefixes are rows of their own, and members are counted map-side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import WORD, arrow
from ledgermill.workspace import stage

#: A conversation starts as the first one of its ``FAMILY`` ids does, for so many turns less one.
FAMILY, HEADS = 20, 4
#: Bytes of joined ids in one row, about.
PIECE = 1 << 16
_ROW_BITS = 33
NOTHING = hashlib.sha256(b"").hexdigest()


def _digest(kind: str, *parts: Column) -> Column:
    """16 bytes that name ``parts``; ``kind`` tells turns, blocks and prefixes apart."""
    whole = F.concat(F.lit(kind).cast("binary"), *parts)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def turns(conversations: DataFrame) -> DataFrame:
    """(c, rank, name, words) of every turn: its place in the order of conversations and turns.

    One range exchange sorts the rows; a rank is a row's place in its task plus the rows of tasks
    before. Turns come by number, null first, and equal numbers by the turn's name; the row's own
    number ends the key, so no conversation and no repeated row makes a range that can't be cut.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    length = F.octet_length(role).cast("string")
    named = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        _digest("turn", *(x.cast("binary") for x in (length, F.lit(" "), role, text))).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("uid"))
    order = [F.asc("c"), F.asc_nulls_first("turn"), F.asc("name"), F.asc("uid")]
    placed = stage(
        named.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("c", "name", "words", F.monotonically_increasing_id().alias("place")), "placed")
    task = F.shiftrightunsigned("place", _ROW_BITS)
    # One row per task from here to the join.
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(placed.groupBy(task.alias("task")).agg(F.count("*").alias("size")).select(
        "task", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")), "starts")
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stage(placed.withColumn("task", task).join(starts, "task").select(
        "c", rank.alias("rank"), "name", "words"), "turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, depth, name, words) of the rebuilt turns, and (c, length) of all conversations; written."""
    found = turns(conversations)
    first = stage(found.groupBy("c").agg(F.min("rank").alias("first"), F.count("*").alias("turns")), "firsts")
    base = F.col("c") - F.col("c") % FAMILY
    own_heads = F.crc32(F.col("c").cast("string").cast("binary")) % HEADS
    bases = first.select(F.col("c").alias("base"), F.col("turns").alias("base_turns"))
    known = stage(
        first.withColumn("base", base).withColumn("h", own_heads).join(bases, "base", "left")
        .withColumn("heads", F.least("h", F.coalesce("base_turns", F.lit(0))))
        .select("c", "base", "first", "h", "heads",
                (F.col("heads") + F.greatest(F.lit(0), F.col("turns") - F.col("h"))).alias("length")), "known")
    own = found.join(known, "c").withColumn("at", F.col("rank") - F.col("first") + 1)
    tail = own.filter("at > h").select(
        "c", (F.col("heads") + F.col("at") - F.col("h")).alias("depth"), "name", "words")
    # Of the conversations that others start as, up to HEADS - 1 turns each, for FAMILY of them.
    heads = own.filter(f"c = base AND at < {HEADS}").select("base", F.col("at").alias("depth"), "name", "words")
    head = heads.join(known.filter("heads > 0").select("c", "base", "heads"), "base").filter(
        "depth <= heads").select("c", "depth", "name", "words")
    return stage(tail.unionByName(head), "rebuilt"), known.select("c", "length")


def _blocks(rows: DataFrame, levels: int) -> list[DataFrame]:
    """For every level k the whole blocks of 2^k turns: (c, block, name, words of the last turn)."""
    out = [rows.select("c", (F.col("depth") - 1).alias("block"), "name", "words")]
    for k in range(1, levels):
        half = F.col("block") % 2
        pairs = out[-1].groupBy("c", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("left"),
            F.max(F.when(half == 1, F.col("name"))).alias("right"),
            F.max(F.when(half == 1, F.col("words"))).alias("words"))
        out.append(stage(pairs.filter("left IS NOT NULL AND right IS NOT NULL").select(
            "c", "block", _digest("block", "left", "right").alias("name"), "words"), f"blocks-{k}"))
    return out


def prefixes(rows: DataFrame, lengths: DataFrame, levels: int) -> DataFrame:
    """(c, depth, name, words of the last turn) of every prefix of every conversation.

    From the tallest level down, each names the prefixes at the odd multiples of its height.
    """
    named = lengths.select("c", F.lit(0).cast("long").alias("depth"), _digest("root").alias("name"),
                           F.lit(0).cast("long").alias("words"))
    for k, blocks in reversed(list(enumerate(_blocks(rows, levels)))):
        above = named.select("c", "depth", F.col("name").alias("above"))
        cut = blocks.filter("block % 2 = 0").withColumn("depth", F.shiftleft("block", k)).join(
            above, ["c", "depth"]).select(
                "c", (F.col("depth") + (1 << k)).alias("depth"),
                _digest("prefix", "above", "name").alias("name"), "words")
        named = named.unionByName(stage(cut, f"prefixes-{k}"))
    return named


def nodes(named: DataFrame) -> DataFrame:
    """Every distinct prefix with its smallest member, members, parent and children; written."""
    found = stage(named.groupBy("name", "depth").agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words")), "named")
    shorter = named.select(F.col("c").alias("conv_id"), (F.col("depth") + 1).alias("depth"),
                           F.col("name").alias("parent"))
    linked = stage(found.join(shorter, ["conv_id", "depth"], "left"), "linked")
    children = linked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(
        F.count("*").alias("n_children"))
    return stage(linked.join(children, "name", "left").select(
        "name", "depth", "conv_id", "parent", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")


def grafted(trie: DataFrame, named: DataFrame, levels: int) -> DataFrame:
    """(name, n_leaves, saved_tokens): sums of ``leaves`` and ``saved`` over every node's subtree.

    Level k joins heights of 2^k in pairs. The root of a lower trie lies at an odd multiple of 2^k
    and holds its trie's total by then; the total goes to the 2^k nodes above it, which any of its
    members passes. Totals of roots with one parent are added up before they go.
    """
    grafts = [trie.select("name", "depth", "leaves", "saved")]
    for k in range(levels):
        height = 1 << k
        at_cut = f"depth % {2 * height} = {height}"
        sums = grafts[0]
        for more in grafts[1:]:
            sums = sums.unionByName(more)
        total = sums.filter(at_cut).groupBy("name").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        roots = trie.filter(at_cut).select("name", "parent", "depth", "conv_id").join(total, "name")
        joined = roots.groupBy("parent", "depth").agg(
            F.min("conv_id").alias("c"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        up = joined.select("c", "leaves", "saved", F.explode(
            F.sequence(F.col("depth") - height, F.col("depth") - 1)).alias("depth"))
        upper = named.filter(f"shiftright(depth, {k}) % 2 = 0").select("c", "depth", "name")
        grafts.append(stage(up.join(upper, ["c", "depth"]).groupBy("name", "depth").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"grafts-{k}"))
    every = grafts[0]
    for more in grafts[1:]:
        every = every.unionByName(more)
    return stage(every.groupBy("name").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "totals")


def ends(named: DataFrame, lengths: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end.

    Ids are sorted by ranges of (node, id), so a node of many ids is many tasks' work; each task
    joins its ids of a node to pieces, and a node's pieces, a few bytes an id, are hashed one after
    another as they stream by.
    """
    last = named.join(lengths.withColumnRenamed("length", "depth"), ["c", "depth"]).select("name", "c")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, ids, size = None, 0, [], 0
        for batch in batches:
            made: list[tuple[bytes, int, str]] = []
            for node, c in zip(*(x.to_pylist() for x in batch.columns)):
                if node != name or size >= PIECE:
                    if ids:
                        made.append((name, first, ",".join(ids)))
                    name, first, ids, size = node, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield _pieces(made)
        if ids:
            yield _pieces([(name, first, ",".join(ids))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            made = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node != name:
                    if state is not None:
                        made.append((name, state.hexdigest()))
                    name, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(made)
        if state is not None:
            yield _digests([(name, state.hexdigest())])

    pieces = stage(last.repartitionByRange("name", "c").sortWithinPartitions("name", "c").transform(
        arrow, join, "name binary, first long, ids string"), "ends")
    return (pieces.repartition("name").sortWithinPartitions("name", "first")
            .transform(arrow, hashed, "name binary, ends_sha256 string"))


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()))],
        names=["name", "first", "ids"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string()))], names=["name", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``.

    Null roles and texts count as empty, a null turn comes before all others, and equal turns come
    by a digest of role and text. Repeated rows are turns of their own. Rows with a null
    ``conv_id`` belong to no conversation and are left out. A conversation without turns, which
    can be when it starts as one that is absent, ends at the root. An empty table has no
    conversation, hence no node; other columns are not read. Remainders are Spark's: of a negative
    id they are negative.
    """
    rows, lengths = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    levels = max(1, int(deepest).bit_length())
    named = prefixes(rows, lengths, levels)
    trie = nodes(named)
    totals = grafted(trie, named, levels)
    ended = stage(ends(named, lengths), "ended")
    above = trie.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (trie.join(above, "parent", "left").join(totals, "name").join(ended, "name", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))

"""A uniform shuffle into shards of exact sizes, with DataFrame functions only.

The number of rows that each input cell gives to each shard is drawn first: a matrix with the
cells' sizes as row sums and the shards' sizes as column sums, from the multivariate
hypergeometric law that a uniform shuffle would follow. Then each cell permutes its rows and deals
them out by its line of the matrix, rows are exchanged, and each shard permutes what it got.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.workspace import stage

SHARDS, SEED = 24, 11
#: Cells at most; the matrix on the driver has so many lines.
CELLS = 4096
#: Rows of one part of a shard, about.
PART = 4096


def hypergeometric(good: int, bad: int, draws: int, rng: random.Random) -> int:
    """How many of ``draws`` from good + bad are good. Exact for any size, by inversion.

    Weights follow from the mode by their ratios, over 14 standard deviations to either side.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1)))
    reach = int(14 * spread) + 30
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    weight = np.concatenate(([0.0], np.cumsum(ratio)))
    weight = np.exp(weight - weight.max())
    upto = np.cumsum(weight)
    return low + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def matrix(cells: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """For each cell the rows it gives to each shard; row and column sums are as given."""
    rng, left, out = random.Random(seed), list(shards), []
    for size in cells:
        line, rest, pool = [], size, sum(left)
        for s, room in enumerate(left):
            pool -= room
            n = hypergeometric(room, pool, rest, rng)
            line.append(n)
            left[s] -= n
            rest -= n
        out.append(line)
    return out


def sizes(rows: int, shards: int) -> list[int]:
    """Sizes of the shards, one row apart at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ('rows'), ``shard``, ``slot`` and
    ``grown_shard`` (null) of every row of ``docs``.

    Shards hold equally many rows, one more or less; slots run from 0 without a gap. Null text has
    no bytes: size 8 and checksum 0. Null and repeated ids are rows like any other. With fewer
    rows than shards the last shards are empty; an empty table gives an empty one. Other columns
    are not read. The same files under the same split settings give the same shards.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    uid = F.monotonically_increasing_id()
    rows = stage(docs.select(
        "doc_id", row_size(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        uid.alias("uid")), "rows")
    # Input partitions are the upper bits of the id; beyond CELLS several make one cell.
    rows = rows.withColumn("cell", F.pmod(F.shiftrightunsigned("uid", 33), F.lit(CELLS)))
    counted = sorted((r["cell"], r["count"]) for r in rows.groupBy("cell").count().collect())
    total = sum(n for _, n in counted)
    lines = matrix([n for _, n in counted], sizes(total, shards), seed)
    ends = [(c, [int(e) for e in np.cumsum(line)]) for (c, _), line in zip(counted, lines)]
    plan = F.broadcast(spark.createDataFrame(ends, "cell long, ends array<long>"))  # CELLS lines at most

    order = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed), "uid"), "uid")
    dealt = (rows.withColumn("rank", F.row_number().over(order) - 1).join(plan, "cell")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank")))))
    parts = max(1, total // (shards * PART))
    second = F.xxhash64(F.lit(seed + 1), "uid")
    dealt = stage(dealt.select("doc_id", "size", "text_crc32", "uid", "shard",
                               F.pmod(second, F.lit(parts)).alias("part")), "dealt")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", "part").count()
              .select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    starts = stage(starts, "starts")
    inside = Window.partitionBy("shard", "part").orderBy(second, "uid")
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("start") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))

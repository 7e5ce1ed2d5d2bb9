"""Quality by importance resampling.

Words and word pairs are hashed into buckets. One model holds the buckets' shares in texts
labelled good (the target), one those in all texts. A text's weight is the log of the ratio of
its probabilities under the two; adding Gumbel noise and taking the k largest draws k texts
without replacement in proportion to their weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import arrow
from ledgermill.workspace import stage

BUCKETS, SEED = 8192, 23
#: Labelled good rows from which the target model is fitted, at most.
TARGET_ROWS = 20_000
_WORDS = re.compile(r"\w+|[^\w\s]+")
_CACHE = 300_000
_hashes: dict[str, int] = {}


def _hash(word: str) -> int:
    if len(_hashes) >= _CACHE:
        _hashes.clear()
    _hashes[word] = out = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    return out


def features(text: str | None) -> np.ndarray:
    """Buckets of a text's words and neighbouring word pairs, lower case, repeats included."""
    words = _WORDS.findall((text or "").lower())
    if not words:
        return np.empty(0, np.int64)
    one = np.array([_hashes.get(w) or _hash(w) for w in words], np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + (one[1:] ^ (one[1:] >> np.uint64(29)))
    two ^= two >> np.uint64(32)
    return (np.concatenate((one, two)) % np.uint64(BUCKETS)).astype(np.int64)


def log_ratios(docs: DataFrame, good: DataFrame) -> np.ndarray:
    """For every bucket the log of target share over raw share, each count plus one.

    ``good`` has the ids of the target rows, ``TARGET_ROWS`` at most, so it may be broadcast; the
    raw model counts every row. Counts are summed in the tasks, then by bucket.
    """
    marked = docs.join(F.broadcast(good.withColumn("target", F.lit(True))), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist()):
                counts = np.bincount(features(text.as_py()), minlength=BUCKETS)
                total[0] += counts
                if target:
                    total[1] += counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])],
            names=["bucket", "raw", "good"])

    sums = (marked.select(F.col("text").cast("string"), "target")
            .transform(arrow, run, "bucket long, raw long, good long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect())
    counts = np.ones((2, BUCKETS))
    for r in sums:  # BUCKETS rows
        counts[:, r["bucket"]] += r["raw"], r["good"]
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of ``column``: counts in 1024 bins, narrowed to a single value."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low != high:
        width = high - low
        at = F.least(F.lit(1023), F.floor((F.col(column) - F.lit(low)) / F.lit(width) * 1024))
        bins = (df.filter((F.col(column) >= low) & (F.col(column) <= high))
                .groupBy(at.alias("bin"))
                .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
                .collect())  # 1024 rows
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def top(df: DataFrame, column: str, unique: str, k: int) -> Column:
    """Whether a row is among the k largest of ``column``, ties by the larger ``unique``."""
    n = df.count()
    if k <= 0 or n == 0:
        return F.lit(False)
    if k >= n:
        return F.lit(True)
    value = largest(df, column, k)
    sure = F.col(column) > value
    ties = df.filter(F.col(column) == value)
    rest = k - df.filter(sure).count()
    if rest == ties.count():
        return sure | (F.col(column) == value)
    return sure | ((F.col(column) == value) & (F.col(unique) >= largest(ties, unique, rest)))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None,
             seed: int = SEED) -> DataFrame:
    """``doc_id``, ``log_weight``, ``gumbel_key`` and ``kept`` of every row of ``docs``.

    ``share`` of the rows, rounded, are kept; by default the share of good labels (``quality`` 1)
    among labelled rows, 1 without labels. Null and empty texts weigh as the empty product, log 0.
    Noise comes from the id and the text, so reruns agree; rows equal in both are told apart by
    file order. Null ids have no label. An empty table gives an empty one; other columns are not
    read.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    if share is None:
        good, every = known.agg(F.sum(F.expr("int(quality = 1)")), F.count("*")).first()
        share = good / every if every else 1.0
    target = (known.filter("quality = 1").select("doc_id")
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(TARGET_ROWS))
    ratio = log_ratios(docs.select("doc_id", "text"), stage(target, "target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                weight = float(ratio[features(text)].sum())
                drawn = xxhash.xxh64(f"{seed}|{doc_id}|")
                drawn.update((text or "").encode("utf-8", "surrogatepass"))
                u = ((drawn.intdigest() >> 11) + 0.5) / (1 << 53)
                weights.append(weight)
                keys.append(weight - float(np.log(-np.log(u))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weights, pa.float64()), pa.array(keys, pa.float64())],
                names=["doc_id", "log_weight", "gumbel_key"])

    rows = docs.select("doc_id", F.col("text").cast("string"))
    schema = rows.select("doc_id", F.lit(0.0).alias("log_weight"), F.lit(0.0).alias("gumbel_key")).schema
    scored = rows.transform(arrow, run, schema)
    scored = stage(scored.withColumn("uid", F.monotonically_increasing_id()), "scored")
    keep = top(scored, "gumbel_key", "uid", int(share * scored.count() + 0.5))
    return scored.select("doc_id", "log_weight", "gumbel_key", keep.alias("kept"))

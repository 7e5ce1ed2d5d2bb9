"""Which files of a table may hold given keys.

Data files carry Parquet's own Bloom filters on the key, which literal keys of a small batch probe,
so row groups that can't hold one are not read. For larger batches a table of filters, one for each
part of a file that a task read, lies in the table's folder under a name that readers pass over:
the batch's key hashes meet it in tasks and only files with a hit are read. The first such merge
after files came in adds their filters, so the keys of a file are read once. Files without a
filter are always read: the filters save work and never decide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgermill.operators.tables import (
    append, data_files, finish_swaps, rewrite_table, table_exists,
)

#: Keys that are probed as literals, and keys that meet the filter table, at most.
LITERALS, HASHES = 200, 100_000
#: A table is at least so many times as large as a batch that meets its filters.
RATIO = 10
#: Bits of a filter for each key and probes for each: some 3 in 10 million misses pass.
BITS, PROBES = 32, 16
#: Files of the filter table from which it is rewritten, without the filters of files that are gone.
FILTER_FILES = 64
FILTERS = "_key_filters"
_SCHEMA = "file string, keys long, bits binary"
_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"

# Ship this module's code with the query, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_options(key: str) -> dict[str, str]:
    """Writer options for a Bloom filter on ``key`` in every row group, as large as its keys need."""
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.fpp#{key}": "0.00001",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(4 << 20),
        f"parquet.bloom.filter.candidates.number#{key}": "12",
    }


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(f"`{k}`") for k in keys))


def _places(hashes: np.ndarray, size: int, probe: int) -> np.ndarray:
    """Bit places of one probe in a filter of ``size`` bits, a power of two; double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes + np.uint64(probe) * step) & np.uint64(size - 1)


def bloom(hashes: np.ndarray) -> bytes:
    """The filter of distinct 64-bit hashes."""
    size = 1 << max(12, (len(hashes) * BITS - 1).bit_length())
    bits = np.zeros(size, bool)
    for probe in range(PROBES):
        bits[_places(hashes, size, probe)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def any_hit(bits: bytes, hashes: np.ndarray) -> bool:
    """Whether a filter may hold one of the hashes; most fall out after a probe or two."""
    table, left = np.frombuffer(bits, np.uint8), hashes
    for probe in range(PROBES):
        if not len(left):
            return False
        at = _places(left, 8 * len(table), probe)
        left = left[(table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
    return bool(len(left))


def relative_file() -> Column:
    """A row's file below the table's folder: the partition folders and the name."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"((?:[^/]+=[^/]*/)*[^/]+)$", 1)


def stored_filters(spark: SparkSession, path: str) -> DataFrame:
    folder = f"{path}/{FILTERS}"
    if table_exists(spark, folder):
        return spark.read.schema(_SCHEMA).parquet(folder)
    return spark.createDataFrame([], _SCHEMA)


def add_filters(table: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Add filters of the files that have none; only their key columns are read.

    A task adds one filter for what it reads of a file, so no file is gathered in one place.
    """
    spark = table.sparkSession
    known = stored_filters(spark, path).select("file").distinct()
    files = table.select(
        F.col("_metadata.file_path").alias("uri"), relative_file().alias("file")).distinct()
    new = [row[0] for row in files.join(known, "file", "left_anti").select("uri").collect()]
    if not new:
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts = None, []

        def done() -> pa.RecordBatch:
            hashes = np.unique(np.concatenate(parts)).view(np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(hashes)], pa.int64()), pa.array([bloom(hashes)], pa.binary())],
                names=["file", "keys", "bits"])

        for batch in batches:
            names, hashes = batch.column(0), batch.column(1).to_numpy()
            ends = pc.run_end_encode(names)
            begin = 0
            for this, end in zip(ends.values.to_pylist(), ends.run_ends.to_pylist()):
                if this != name:
                    if parts:
                        yield done()
                    name, parts = this, []
                parts.append(hashes[begin:end])
                begin = end
        if parts:
            yield done()

    made = table.filter(F.col("_metadata.file_path").isin(new)).select(
        relative_file().alias("file"), key_hash(keys).alias("hash"))
    folder = f"{path}/{FILTERS}"
    finish_swaps(spark, folder)
    append(made.mapInArrow(run, _SCHEMA), folder)
    stored = stored_filters(spark, path)
    if len(before := data_files(stored)) > FILTER_FILES:
        rewrite_table(stored.join(files, "file", "left_semi"), folder, before,
                      arrange=lambda rows: rows.hint("rebalance"))


def files_with(path: str, table: DataFrame, hashes: np.ndarray) -> list[str]:
    """URIs of the table's files that may hold one of the key hashes.

    A file is left out only where each filter it has says no; one without filters is in.
    """
    wanted = np.asarray(hashes, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array([any_hit(b.as_buffer(), wanted) for b in batch.column(1)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), hit], names=["file", "hit"])

    tested = stored_filters(table.sparkSession, path).select("file", "bits").mapInArrow(run, "file string, hit boolean")
    verdict = tested.groupBy("file").agg(F.bool_or("hit").alias("hit"))
    files = table.select(
        F.col("_metadata.file_path").alias("uri"), relative_file().alias("file")).distinct()
    return [r[0] for r in files.join(verdict, "file", "left").filter(F.coalesce("hit", F.lit(True)))
            .select("uri").collect()]


@contextmanager
def pushed_literals(spark: SparkSession, count: int) -> Iterator[None]:
    """Inside, lists of up to ``count`` literals reach the row groups' filters value by value."""
    before = spark.conf.get(_THRESHOLD)
    spark.conf.set(_THRESHOLD, str(max(count, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_THRESHOLD, before)


def narrowed(table: DataFrame, path: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with no more than the rows in files, or row groups, that may hold a batch's key.

    ``batch`` is a stored table of distinct keys. Up to ``LITERALS`` of them are literals in the
    scan's filter (run what follows inside ``pushed_literals``). Up to ``HASHES`` meet the filter
    table, which first gets the filters of new files. With more, or where the table is not much
    larger than the batch, nearly every file holds one, and the table stays as it is.
    """
    count = batch.count()
    if count <= LITERALS:
        some = [r[0] for r in batch.select(keys[0]).collect() if r[0] is not None]
        return table.filter(F.col(keys[0]).isin(some) if some else F.lit(False))
    if count > HASHES or _bytes(table) < RATIO * _bytes(batch):
        return table
    add_filters(table, path, keys)
    hashes = batch.select(key_hash(keys).alias("h")).toArrow().column("h").to_numpy()
    return table.filter(F.col("_metadata.file_path").isin(files_with(path, table, hashes)))


def _bytes(stored: DataFrame) -> int:
    """Size of a stored table's files, from the listing; no job runs."""
    return int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

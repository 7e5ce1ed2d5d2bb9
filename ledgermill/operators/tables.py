"""Operations on parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgermill.workspace import hadoop_path, remove

#: Bits of a column's range in a Z-order key, and rows from which the ranges are drawn, about.
RANGE_BITS, SAMPLE = 6, 10_000
#: The folder of rows whose partition value is NULL or empty.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
Arrange = Callable[[DataFrame], DataFrame]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True where the folder holds data, not just markers such as ``_SUCCESS``."""
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath) and any(
        not entry.getPath().getName().startswith((".", "_")) for entry in fs.listStatus(jpath)
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A table whose columns may have grown over time.

    Columns that older files lack are NULL. Without a given schema the files' schemas are merged;
    Spark's default would trust whichever file it looks at.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a table; parquet answers from its footers."""
    return spark.read.parquet(path).count()


def _entries(spark: SparkSession, folder: str) -> list:
    """A folder's entries but for markers; none where there is no folder."""
    jpath, fs = hadoop_path(spark, folder)
    if not fs.exists(jpath):
        return []
    return [e for e in fs.listStatus(jpath) if not e.getPath().getName().startswith((".", "_"))]


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Names of a folder's data files."""
    return {entry.getPath().getName() for entry in _entries(spark, folder)}


def _names(spark: SparkSession):
    """Spark's own rules for folder names of partition values."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder that Spark writes rows of a partition value to."""
    if value is None or value == "":
        return f"{_names(spark).escapePathName(column)}={NO_VALUE}"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return f"{_names(spark).escapePathName(column)}={_names(spark).escapePathName(text)}"


def latest_partition(spark: SparkSession, path: str, column: str, kind: str = "date") -> DataFrame:
    """One row with the highest partition value that has files, NULL for a table without one.

    The values are the folders' names, so no data file is opened: the table's folder is listed
    once, then its partitions from the highest down until one has files. Rows whose value is NULL
    are in a folder of their own, which isn't a value; names are unescaped before they are cast.
    """
    prefix = f"{_names(spark).escapePathName(column)}="
    names = sorted(n for n in _files(spark, path) if n.startswith(prefix) and n != prefix + NO_VALUE)
    found = spark.createDataFrame(
        [(n, _names(spark).unescapePathName(n.removeprefix(prefix))) for n in names],
        "name string, value string").select("name", F.col("value").cast(kind).alias("latest"))
    # As many rows as the listing that they come from.
    for row in found.orderBy(F.desc("latest"), "name").toLocalIterator():
        if _files(spark, f"{path}/{row['name']}"):
            return found.filter(F.col("name") == row["name"]).select("latest")
    return spark.range(1).select(F.lit(None).cast(kind).alias("latest"))


def append(
    df: DataFrame, path: str, partition_by: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    writer = df.write.mode("append").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def append_quarantine(rejected: DataFrame, path: str) -> None:
    append(rejected.withColumn("quarantined_at", F.current_timestamp()), path)


def replace_partition(
    df: DataFrame, path: str, partition_by: str, values: Sequence | None = None,
    write: Callable[[], None] | None = None,
) -> None:
    """Replace the partitions that occur in ``df``; running it twice changes nothing.

    ``values`` names the partitions that ``df`` is the whole new content of: one of them that has
    no rows in ``df`` is removed, so that nothing stale stays. ``write`` is another way to write
    ``df`` over its partitions.
    """
    spark = df.sparkSession
    folders = [f"{path}/{partition_folder(spark, partition_by, v)}" for v in values or ()]
    before = {folder: _files(spark, folder) for folder in folders}
    if write:
        write()
    else:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by)
            .parquet(path)
        )
    for folder, names in before.items():
        if names and _files(spark, folder) == names:  # a written partition has files of its own
            remove(spark, folder)
    spark.catalog.refreshByPath(path)


def data_files(table: DataFrame) -> list[str]:
    """URIs of the files that a scan would read, partition filters applied."""
    return [row[0] for row in table.select("_metadata.file_path").distinct().collect()]


def _uri_path(spark: SparkSession, uri: str):
    """The Hadoop path of a file as scans name it, with what is escaped in its URI put back."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def swap_files(spark: SparkSession, path: str, copy: str, old: Iterable[str]) -> None:
    """Move the finished files of ``copy`` into the table's folder, then delete the ``old`` ones.

    Files are moved, not written again. What is to be done is noted in the table's folder first:
    an interrupted swap is finished by ``finish_swaps``, which merges and rewrites call before
    anything else. Until the old files are gone a reader may see rows twice, but never none.
    """
    note = f"{path}/_swap-{uuid.uuid4().hex}.json"
    jpath, fs = hadoop_path(spark, note)
    out = fs.create(jpath)
    out.write(bytearray(json.dumps({"copy": copy, "old": list(old)}).encode()))
    out.close()
    _finish(spark, path, note)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Finish the swaps that were noted in a table's folder and not completed; copies that were
    never noted go. A table has one writer at a time."""
    jpath, fs = hadoop_path(spark, path)
    if fs.exists(jpath):
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        for entry in fs.globStatus(path_of(jpath, "_swap-*.json")):
            _finish(spark, path, entry.getPath().toString())
        for entry in fs.globStatus(path_of(jpath, "_copy-*")):
            fs.delete(entry.getPath(), True)


def _finish(spark: SparkSession, path: str, note: str) -> None:
    jnote, fs = hadoop_path(spark, note)
    stream = fs.open(jnote)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    try:
        todo = json.loads(text)
    except ValueError:  # interrupted while it was noted: nothing has been done
        fs.delete(jnote, False)
        return
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    table, _ = hadoop_path(spark, path)

    def move(source, target) -> None:
        fs.mkdirs(target)
        for entry in fs.listStatus(source):
            name = entry.getPath().getName()
            if entry.isDirectory():
                move(entry.getPath(), path_of(target, name))
            elif not name.startswith((".", "_")) and not fs.rename(entry.getPath(), path_of(target, name)):
                raise OSError(f"cannot move {entry.getPath()} to {target}")

    copy, there = hadoop_path(spark, todo["copy"])
    if there.exists(copy):
        move(copy, table)
    for uri in todo["old"]:
        fs.delete(_uri_path(spark, uri), False)
    fs.delete(jnote, False)
    spark.catalog.refreshByPath(path)


def rewrite_table(
    rows: DataFrame, path: str, old: Iterable[str], partition_by: str | None = None,
    arrange: Arrange | None = None, options: Mapping[str, str] | None = None,
    more: DataFrame | None = None,
) -> None:
    """Replace the ``old`` files of a table by rows computed from them, and ``more`` new rows.

    The rows are arranged and written once, beside the table and on its file system, before any of
    its files go; the finished files are then moved into it.
    """
    spark = rows.sparkSession
    # Below the table's folder a move stays within one file system; readers pass over the name.
    copy = f"{path.rstrip('/')}/_copy-{uuid.uuid4().hex}"
    for part in (rows, more):
        if part is not None:
            append(arrange(part) if arrange else part, copy, partition_by, options)
    swap_files(spark, path, copy, old)
    remove(spark, copy)


def _days(table: DataFrame, partition_by: str | None, values: Sequence | None) -> DataFrame:
    return table.filter(F.col(partition_by).isin(list(values))) if values else table


def compact_table(
    spark: SparkSession, path: str, partition_by: str | None = None, values: Sequence | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Rewrite a table, or the given partitions, in files of the size adaptive execution aims at.

    ``rebalance`` merges small pieces and splits a partition value that outgrows one task. Every
    row is written once.
    """
    finish_swaps(spark, path)
    columns = [partition_by] if partition_by else []
    rows = _days(read_table(spark, path), partition_by, values)
    rewrite_table(rows, path, data_files(rows), partition_by,
                  lambda df: df.hint("rebalance", *columns), options)


def range_cuts(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS) -> list[list]:
    """For each column the values that cut it into 2^bits ranges of equally many rows, about.

    They come from a random sample of some ``SAMPLE`` rows and decide only where rows lie, not
    which. A value that fills several ranges cuts once, a column with few values at each of them.
    """
    count = df.count()
    sample = df.select(*columns).sample(min(1.0, SAMPLE / max(count, 1)), seed=1).collect()
    out = []
    for k in range(len(columns)):
        values = sorted(row[k] for row in sample if row[k] is not None)
        at = range(len(values) >> bits, len(values), max(1, len(values) >> bits))
        out.append(sorted({values[i] for i in at})[-(1 << bits) + 1:])
    return out


def z_key(columns: Sequence[str], cuts: Sequence[list], kinds: Mapping[str, T.DataType],
          bits: int = RANGE_BITS) -> Column:
    """The columns' range numbers with their bits interleaved, highest first; NULL is range 0."""
    z = F.lit(0).cast("long")
    for k, (name, values) in enumerate(zip(columns, cuts)):
        number = F.lit(0)
        if values:
            known = F.array(*(F.lit(v).cast(kinds[name]) for v in values))
            number = F.coalesce(F.when(F.col(name).isNotNull(), F.size(
                F.filter(known, lambda cut: cut <= F.col(name)))), F.lit(0))
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            z = z + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - k)
    return z


def clustered(df: DataFrame, columns: Sequence[str], partition_by: str | None = None) -> DataFrame:
    """Rows in Z-order of ``columns``, so that files hold narrow ranges of every one of them.

    One range exchange by partition and Z-order key. Where many rows share a key, a hash of the
    row cuts them. ``df`` is read to count, to draw the ranges and to sort: stage it where
    computing it is dear.
    """
    first = [partition_by] if partition_by else []
    z = z_key(columns, range_cuts(df, columns), {f.name: f.dataType for f in df.schema.fields})
    rest = [c for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")]
    marked = df.withColumns({"_z": z, "_row": F.xxhash64(*(F.col(f"`{c}`") for c in rest))})
    return (marked.repartitionByRange(*first, "_z", "_row")
            .sortWithinPartitions(*first, "_z", *columns).drop("_z", "_row"))


def cluster_table(
    spark: SparkSession, path: str, columns: Sequence[str], partition_by: str | None = None,
    values: Sequence | None = None, options: Mapping[str, str] | None = None,
) -> None:
    """Rewrite a table, or the given partitions, in Z-order of data columns."""
    finish_swaps(spark, path)
    rows = _days(read_table(spark, path), partition_by, values)
    rewrite_table(rows, path, data_files(rows), partition_by,
                  lambda df: clustered(df, columns, partition_by), options)

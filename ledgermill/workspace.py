"""Working tables in the folder the cluster shares.

Intermediate results that several jobs read are written once as parquet below
``spark.checkpoint.dir``. A lost executor then costs only the tasks it ran, and readers get
column pruning, which ``checkpoint()`` files do not offer.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
# The innermost scope of this thread's context: a streaming batch, which runs in another thread,
# never leaves its files to a scope it doesn't know.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="ledgermill-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/ledgermill-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete whatever was staged inside once the block is done.

    After a failure everything stays, as it may hold the only full copy of a partition.
    """
    staged: list[str] = []
    token = _scope.set(staged)
    try:
        yield
    finally:
        _scope.reset(token)
    for path in staged:
        remove(spark, path)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table.

    A partitioned table is rebalanced first: without it every task would write a file into every
    partition, with it files come out evenly sized and a large partition is still split.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    else:
        writer = df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete one working table."""
    jpath, fs = hadoop_path(spark, path)
    fs.delete(jpath, True)


def drop_workspace(spark: SparkSession) -> None:
    """Delete everything this application staged. Frames read from it become unusable."""
    remove(spark, shared_root(spark))
    own = _local_roots.pop(spark.sparkContext.applicationId, None)
    if own:
        shutil.rmtree(own, ignore_errors=True)

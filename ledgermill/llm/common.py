"""Helpers that several operators share."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.workspace import shared_root, stage

#: Words are runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows and bytes of one batch to a Python worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession) -> None:
    """Once per application, give all Python workers this package from the shared folder, so that
    executors need not have it installed and workers keep its modules between tasks.

    Texts may be long, so batches to the workers hold few rows and, beyond one row, few bytes.
    Spark reads these two settings when a query runs, so they are set, and stay, in each session
    that runs an operator.
    """
    for name, most in BATCH.items():
        if spark.conf.get(name) != most:
            spark.conf.set(name, most)
    application = spark.sparkContext.applicationId
    if (application, "") in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as out:
        for file in sorted((top / "ledgermill").rglob("*.py")):
            out.write(file, file.relative_to(top))
    path = f"{shared_root(spark)}/ledgermill.zip"
    files.put(path, content.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add((application, ""))


def shared_copy(spark: SparkSession, path: str) -> str:
    """Where all executors find a copy of a file of the driver's machine, named by its content."""
    content = Path(path).read_bytes()
    digest = hashlib.sha256(content).hexdigest()
    uri = f"{shared_root(spark)}/files/{digest[:32]}-{Path(path).name}"
    application = spark.sparkContext.applicationId
    if (application, uri) not in _shipped:
        files.put(uri, content)
        _shipped.add((application, uri))
    return uri


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
          schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else; plain ASCII takes the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, keep: list[str], **values: Column) -> DataFrame:
    """``keep`` and new columns, which later projections cannot inline and so compute again."""
    row = F.struct(*(value.alias(name) for name, value in values.items()))
    return df.select(*keep, F.inline(F.array(row)))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def anchored(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with two more columns that identify each row, and their names.

    They are the file and the row's place in it, the same on every read whatever the splits. A
    frame that isn't a plain Parquet scan is written to the shared folder first.
    """
    file, row = fresh(df, "anchor_file"), fresh(df, "anchor_row")

    def mark(scan: DataFrame) -> DataFrame:
        meta = scan.metadataColumn("_metadata")
        return scan.select(*(scan[f"`{c}`"] for c in scan.columns),
                           meta["file_path"].alias(file), meta["row_index"].alias(row))

    try:
        return mark(df), [file, row]
    except AnalysisException:
        return mark(stage(df, "anchored")), [file, row]

"""Session builder."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when the split costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dimensions below this size are broadcast; above it Spark falls back to a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Compressed files grow in memory; size estimates must know, or too much is broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(
    app_name: str = "ledgermill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    shared_folder: str | None = None,
) -> SparkSession:
    """A UTC session with adaptive execution; ``extra`` wins over the defaults.

    ``shared_folder`` is where working tables go, a folder that all executors reach.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if shared_folder:
        settings["spark.checkpoint.dir"] = shared_folder
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

"""One row per key, and merging batches into tables."""

from decimal import Decimal
from pathlib import Path

import pytest
from conftest import at, transaction
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import clean, dedup, tables, upsert
from ledgermill.workspace import stage


@pytest.fixture
def silver(frame):
    def build(*rows):
        typed = frame(*rows).withColumns({
            "event_date": F.to_date("timestamp"),
            "device_fingerprint": F.lit(None).cast("string"),
            "ip_country": F.lit(None).cast("string"),
        })
        return typed

    return build


def test_newer_arrival_wins(frame):
    kept = dedup.dedup_latest(frame(
        transaction(1, status="pending", ingestion_timestamp=at(1)),
        transaction(1, status="completed", ingestion_timestamp=at(2)))).collect()
    assert [r["status"] for r in kept] == ["completed"]


def test_tie_goes_to_the_later_position(frame):
    kept = dedup.dedup_latest(frame(
        transaction(1, 5, status="pending"), transaction(1, 9, status="completed"),
        transaction(1, 7, status="failed"))).collect()
    assert [r["kafka_offset"] for r in kept] == [9]


def test_sample_keeps_one_row_per_id(sample):
    valid = clean.split_valid(sample)
    kept = dedup.dedup_latest(valid)
    assert kept.filter("transaction_id = 'TXN001'").count() == 1
    assert kept.count() == valid.select("transaction_id").distinct().count()


def test_merge_actions(silver):
    stored = silver(
        transaction(1, ingestion_timestamp=at(1)), transaction(2, ingestion_timestamp=at(5)),
        transaction(3, ingestion_timestamp=at(1)), transaction(4, ingestion_timestamp=None))
    batch = silver(
        transaction(1, ingestion_timestamp=at(2), status="failed", merchant="Other",
                    timestamp=at(9, day=16)),
        transaction(2, ingestion_timestamp=at(5), status="failed"),
        transaction(3, ingestion_timestamp=None, status="failed"),
        transaction(4, ingestion_timestamp=at(2), status="failed"),
        transaction(5, amount=Decimal("5")))
    rows = {r["transaction_id"]: r for r in upsert.upsert_latest(stored, batch).collect()}
    assert {k: r["_action"] for k, r in rows.items()} == {
        "TXN001": "update", "TXN002": "duplicate", "TXN003": "duplicate", "TXN004": "duplicate",
        "TXN005": "insert"}
    # Only the updatable columns change; the event day never moves.
    assert rows["TXN001"]["status"] == "failed"
    assert rows["TXN001"]["merchant"] == "Corner Shop"
    assert rows["TXN001"]["event_date"] == at(0).date()


def files(path, day):
    return sorted(p.name for p in Path(path, f"event_date=2024-01-{day}").glob("*.parquet"))


def test_stored_merge_is_idempotent_and_local(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    first = silver(transaction(1, ingestion_timestamp=at(1)),
                   transaction(2, timestamp=at(1, day=16)))
    assert upsert.upsert_transactions(spark, path, first) == {
        "insert": 2, "update": 0, "duplicate": 0}
    untouched = files(path, 16)
    batch = silver(transaction(1, ingestion_timestamp=at(2), status="failed"),
                   transaction(2, timestamp=at(1, day=16)),
                   transaction(3, timestamp=at(3, day=17)))
    assert upsert.upsert_transactions(spark, path, batch) == {
        "insert": 1, "update": 1, "duplicate": 1}
    once = sorted(map(str, spark.read.parquet(path).collect()))
    assert files(path, 16) == untouched
    assert upsert.upsert_transactions(spark, path, batch) == {
        "insert": 0, "update": 0, "duplicate": 3}
    assert sorted(map(str, spark.read.parquet(path).collect())) == once
    assert len(once) == 3


def test_match_in_another_partition(spark, silver, tmp_path):
    """An id that comes back with another event day updates its row where it is."""
    path = str(tmp_path / "silver")
    upsert.upsert_transactions(spark, path, silver(transaction(1, ingestion_timestamp=at(1))))
    moved = silver(transaction(1, ingestion_timestamp=at(2), timestamp=at(1, day=20),
                               status="failed"))
    upsert.upsert_transactions(spark, path, moved)
    row = spark.read.parquet(path).collect()
    assert [(r["status"], str(r["event_date"])) for r in row] == [("failed", "2024-01-15")]


def test_generic_merge_with_insert_values(spark, tmp_path):
    path = str(tmp_path / "unpartitioned")
    stored = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    batch = spark.createDataFrame([(2, "B", 5), (3, "C", 7)], "k int, v string, n int")
    tables.append(stored, path)
    counts = upsert.upsert_table(
        spark, path, batch, ["k"],
        {"n": upsert.source("n") + upsert.target("n")},
        insert_values={"k": upsert.source("k"), "v": F.lit("new")})
    assert counts == {"insert": 1, "update": 1, "duplicate": 0}
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [
        (1, "a", 10), (2, "b", 25), (3, "new", None)]


def test_tables(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    rows = silver(transaction(1), transaction(2, timestamp=at(1, day=16)), transaction(3))
    tables.append(rows.repartition(3), path, "event_date")
    assert tables.table_exists(spark, path) and tables.row_count(spark, path) == 3
    table = spark.read.parquet(path)
    latest = tables.latest_partition(spark, path, "event_date")
    assert str(latest.first()[0]) == "2024-01-16"
    assert "FileScan" not in latest._jdf.queryExecution().toString()
    assert tables.latest_partition(spark, path + "-none", "event_date").first()[0] is None
    before = sorted(map(str, table.collect()))
    tables.compact_table(spark, path, "event_date")
    assert len(files(path, 15)) == 1
    other = files(path, 16)
    tables.cluster_table(spark, path, ["currency", "amount"], "event_date", ["2024-01-15"])
    assert files(path, 16) == other
    assert sorted(map(str, spark.read.parquet(path).collect())) == before
    replacement = rows.filter("transaction_id = 'TXN002'").withColumn("status", F.lit("x"))
    for _ in range(2):
        tables.replace_partition(replacement, path, "event_date")
    statuses = spark.read.parquet(path).select("transaction_id", "status").collect()
    assert sorted(map(tuple, statuses)) == [
        ("TXN001", "completed"), ("TXN002", "x"), ("TXN003", "completed")]


def test_unpartitioned_rewrites(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.range(100).repartition(8).write.parquet(path)
    tables.compact_table(spark, path)
    tables.cluster_table(spark, path, ["id"])
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first()[:] == (100, 4950)


def test_replacing_by_nothing_removes_the_partition(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    rows = silver(transaction(1), transaction(2, timestamp=at(1, day=16)))
    tables.append(rows, path, "event_date")
    first = rows.filter("transaction_id = 'TXN001'")
    tables.replace_partition(first.limit(0), path, "event_date", ["2024-01-15"])
    assert files(path, 15) == [] and len(files(path, 16)) == 1
    tables.replace_partition(first, path, "event_date", ["2024-01-15"])
    tables.replace_partition(first, path, "event_date", ["2024-01-15", "2024-01-16"])
    assert len(files(path, 15)) == 1 and files(path, 16) == []


def test_metrics_tell_duplicates_from_untouched_rows(silver):
    stored = silver(*[transaction(i, ingestion_timestamp=at(5)) for i in range(1, 6)])
    batch = silver(transaction(1, ingestion_timestamp=at(6)),
                   transaction(2, ingestion_timestamp=at(5)), transaction(9))
    found = upsert.upsert_metrics(upsert.upsert_latest(stored, batch)).collect()
    assert dict(map(tuple, found)) == {"insert": 1, "update": 1, "duplicate": 1, "untouched": 3}


def test_a_small_batch_does_not_shuffle_the_table(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    tables.append(silver(*[transaction(i) for i in range(50)]), path, "event_date")
    table = spark.read.schema(schemas.SILVER).parquet(path)
    batch = stage(silver(transaction(1, status="failed"), transaction(60)), "batch")
    known = upsert.known_keys(
        table, batch, ["transaction_id"], upsert.newer())
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    columns = [s for s in plan.split("ReadSchema: ")[1:] if "ingestion_timestamp" in s]
    assert all("amount" not in s.split(">")[0] for s in columns)


def test_merge_into_a_null_partition(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    upsert.upsert_transactions(spark, path, silver(transaction(1, timestamp=None)))
    again = silver(transaction(1, timestamp=None, ingestion_timestamp=at(23), status="failed"))
    assert upsert.upsert_transactions(spark, path, again)["update"] == 1
    rows = spark.read.schema(schemas.SILVER).parquet(path).collect()
    assert [(r["status"], r["event_date"]) for r in rows] == [("failed", None)]


def test_rewrite_is_arranged_once(spark, silver, tmp_path):
    """Sixty-four tasks over three days leave few files in the copy and in the table."""
    path = str(tmp_path / "t")
    rows = silver(*[transaction(i, timestamp=at(1, day=15 + i % 3)) for i in range(300)])
    tables.append(rows, path, "event_date")
    spread = spark.read.schema(schemas.SILVER).parquet(path).repartition(64)
    tables.rewrite_table(
        spread, path, tables.data_files(spread), "event_date",
        lambda df: df.hint("rebalance", "event_date"))
    assert max(len(files(path, d)) for d in (15, 16, 17)) <= 2
    assert spark.read.parquet(path).count() == 300


def test_partition_values_that_need_escaping(spark, tmp_path):
    path = str(tmp_path / "odd")
    rows = spark.createDataFrame([(1, "a b:c"), (2, None), (3, "x/y"), (4, "z%"), (5, "")], "n int, p string")
    tables.append(rows, path, "p")
    latest = tables.latest_partition(spark, path, "p", "string")
    assert [tuple(r) for r in latest.collect()] == [("z%",)]
    tables.replace_partition(rows.filter("n = 1").withColumn("n", F.lit(9)), path, "p", ["a b:c", None, "z%"])
    left = {r["n"]: r["p"] for r in spark.read.schema(rows.schema).parquet(path).collect()}
    assert left == {9: "a b:c", 3: "x/y"}
    tables.replace_partition(rows.limit(0), path, "p", ["a b:c", "x/y"])
    assert tables.latest_partition(spark, path, "p", "string").first()[0] is None


def test_latest_partition_passes_over_null_and_emptied_folders(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(1, "2024-01-02"), (2, "2023-12-31"), (3, None)], "n int, d string")
    tables.append(rows.withColumn("d", F.col("d").cast("date")), path, "d")
    assert str(tables.latest_partition(spark, path, "d").first()[0]) == "2024-01-02"
    (tmp_path / "days" / "d=2025-05-05").mkdir()
    assert str(tables.latest_partition(spark, path, "d").first()[0]) == "2024-01-02"
    numbers = str(tmp_path / "numbers")
    tables.append(spark.range(12).withColumn("p", F.col("id")), numbers, "p")
    assert tables.latest_partition(spark, numbers, "p", "int").first()[0] == 11


def test_compaction_of_escaped_partitions(spark, tmp_path):
    path = str(tmp_path / "odd")
    rows = spark.range(40).withColumn("p", F.when(F.col("id") % 2 == 0, "a b:c%").otherwise(F.lit(None)))
    tables.append(rows.repartition(4), path, "p")
    before = sorted(map(str, spark.read.schema(rows.schema).parquet(path).collect()))
    tables.compact_table(spark, path, "p")
    table = spark.read.schema(rows.schema).parquet(path)
    assert sorted(map(str, table.collect())) == before and len(tables.data_files(table)) == 2


def test_z_order_narrows_every_column(spark, tmp_path):
    """Files' ranges of the second column, of all its values, are a fraction of what a sort leaves."""
    rows = spark.range(20_000).select(
        F.col("id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.format_string("s%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("b"))
    path, plain = str(tmp_path / "z"), str(tmp_path / "plain")
    rows.write.parquet(path)
    rows.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b").write.parquet(plain)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tables.cluster_table(spark, path, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def width(folder, column):
        table = spark.read.parquet(folder).withColumn("f", F.col("_metadata.file_path"))
        spans = table.groupBy("f").agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        number = lambda v: int(str(v).lstrip("s"))
        return sum(number(r["hi"]) - number(r["lo"]) for r in spans) / (1000 * len(spans))

    assert spark.read.parquet(path).count() == 20_000
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(20_000))
    assert width(plain, "b") > 0.9 and width(path, "b") < 0.5 and width(path, "a") < 0.5


def test_z_order_of_nulls_few_values_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(None, "x", 1)] * 30 + [(k % 3, None, k) for k in range(30)], "a int, b string, n int")
    out = tables.clustered(rows, ["a", "b"])
    assert sorted(map(str, out.collect())) == sorted(map(str, rows.collect()))
    assert tables.clustered(rows.limit(0), ["a", "b"]).count() == 0


def test_a_merged_frame_does_not_shuffle_the_target(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    tables.append(silver(*[transaction(i) for i in range(50)]), path, "event_date")
    table = spark.read.schema(schemas.SILVER).parquet(path)
    batch = stage(silver(transaction(1, status="failed"), transaction(60)), "batch")
    plan = upsert.upsert_latest(table, batch)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan

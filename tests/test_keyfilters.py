"""What a merge reads, writes and leaves alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import keyfilters, tables, upsert
from ledgermill.workspace import stage
from silver_rows import silver_rows


@pytest.fixture
def silver(spark):
    return lambda ids, **changes: silver_rows(spark, ids, **changes)


def rows_of(spark, path):
    return sorted(map(str, spark.read.schema(schemas.SILVER).parquet(path).collect()))


def table_files(spark, path):
    return set(tables.data_files(spark.read.schema(schemas.SILVER).parquet(path)))


def spread(spark, silver, path, n=600):
    """A table whose files all span the same range of ids, so that only filters tell them apart."""
    rows = silver(range(n)).repartition(6, F.xxhash64("transaction_id"))
    tables.append(rows, path, "event_date", keyfilters.write_options("transaction_id"))
    keyfilters.add_filters(tables.read_table(spark, path, schemas.SILVER), path, ["transaction_id"])


def rows_read(df):
    """Rows that the table's scan gave, after whatever row groups were skipped; runs ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    found = [s.metrics().apply("numOutputRows").value() for s in scans if "ScanExec" in s.getClass().getName()]
    assert found
    return sum(found)


def test_one_new_id_leaves_every_file_in_place(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    spread(spark, silver, path)
    before = table_files(spark, path)
    assert upsert.upsert_transactions(spark, path, silver([10_000])) == {"insert": 1, "update": 0, "duplicate": 0}
    assert before < table_files(spark, path)
    assert spark.read.parquet(path).count() == 601


def test_only_files_with_updates_are_written_anew(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    spread(spark, silver, path)
    before, newer = table_files(spark, path), silver([7], ingestion_hour=20, status="failed")
    counts = upsert.upsert_transactions(spark, path, newer)
    assert counts == {"insert": 0, "update": 1, "duplicate": 0}
    after = table_files(spark, path)
    assert len(before - after) == 1 and len(after - before) == 1
    table = spark.read.schema(schemas.SILVER).parquet(path)
    assert table.count() == table.select("transaction_id").distinct().count() == 600
    assert table.filter("status = 'failed'").count() == 1


def test_literal_keys_skip_row_groups(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    spread(spark, silver, path)
    table = tables.read_table(spark, path, schemas.SILVER)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def read(ids):
            batch = stage(silver(ids).select("transaction_id"), "batch")
            with keyfilters.pushed_literals(spark, keyfilters.LITERALS):
                return rows_read(keyfilters.narrowed(table, path, batch, ["transaction_id"]).select("amount"))

        # Within the range of ids of every file, so that no minimum or maximum helps.
        absent = ["TXN005x", "TXN300x"] + [f"TXN1{k:02d}y" for k in range(40)]
        assert read(absent) == 0
        assert 0 < read(["TXN005", "TXN300x"]) < 600
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_larger_batches_read_only_files_with_a_hit(spark, silver, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    spread(spark, silver, path)
    table = tables.read_table(spark, path, schemas.SILVER)
    monkeypatch.setattr(keyfilters, "LITERALS", 2)
    monkeypatch.setattr(keyfilters, "RATIO", 0)
    absent = stage(silver([f"TXN{k:03d}z" for k in range(500)]).select("transaction_id"), "batch")
    assert keyfilters.narrowed(table, path, absent, ["transaction_id"]).count() == 0
    home = {r["transaction_id"]: r["f"] for r in table.select("transaction_id", F.col("_metadata.file_path").alias("f")).collect()}
    one = home["TXN005"]
    chosen = stage(silver([i for i, f in home.items() if f == one]).select("transaction_id"), "batch")
    found = keyfilters.narrowed(table, path, chosen, ["transaction_id"])
    assert tables.data_files(found) == [one]
    # New files get their filters first; one without any would always be read.
    tables.append(silver([20_000]), path, "event_date")
    table = tables.read_table(spark, path, schemas.SILVER)
    assert tables.data_files(keyfilters.narrowed(table, path, chosen, ["transaction_id"])) == [one]
    monkeypatch.setattr(keyfilters, "add_filters", lambda *_: None)
    tables.append(silver([30_000]), path, "event_date")
    table = tables.read_table(spark, path, schemas.SILVER)
    assert len(tables.data_files(keyfilters.narrowed(table, path, chosen, ["transaction_id"]))) == 2
    # A batch that is not much smaller than the table is joined with all of it.
    monkeypatch.setattr(keyfilters, "RATIO", 10_000)
    assert len(tables.data_files(keyfilters.narrowed(table, path, chosen, ["transaction_id"]))) == 8


@pytest.mark.parametrize("limits", [(200, 100_000), (0, 100_000), (0, 0)])
def test_every_way_gives_the_same_table(spark, silver, tmp_path, monkeypatch, limits):
    path = str(tmp_path / "silver")
    monkeypatch.setattr(keyfilters, "LITERALS", limits[0])
    monkeypatch.setattr(keyfilters, "HASHES", limits[1])
    monkeypatch.setattr(keyfilters, "RATIO", 0)
    upsert.upsert_transactions(spark, path, silver(range(0, 60)))
    upsert.upsert_transactions(spark, path, silver(range(40, 80), ingestion_hour=20, status="pending"))
    counts = upsert.upsert_transactions(spark, path, silver(range(70, 100), status="failed"))
    assert counts == {"insert": 20, "update": 0, "duplicate": 10}
    got = {r["transaction_id"]: r["status"] for r in spark.read.parquet(path).collect()}
    assert got == {f"TXN{k:03d}": "completed" if k < 40 else "pending" if k < 80 else "failed" for k in range(100)}


def test_an_interrupted_swap_is_finished_by_the_next_merge(spark, silver, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    upsert.upsert_transactions(spark, path, silver(range(20)))
    before = rows_of(spark, path)
    batch = silver(range(10, 30), ingestion_hour=20, status="failed")
    monkeypatch.setattr(tables, "_finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        upsert.upsert_transactions(spark, path, batch)
    monkeypatch.undo()
    assert rows_of(spark, path) == before  # neither new nor copied files are seen
    assert upsert.upsert_transactions(spark, path, batch) == {"insert": 0, "update": 0, "duplicate": 20}
    table = spark.read.schema(schemas.SILVER).parquet(path)
    assert table.count() == 30 and table.filter("status = 'failed'").count() == 20
    assert not [p for p in (tmp_path / "silver").iterdir() if p.name.startswith(("_copy", "_swap"))]


def test_filters_of_files_that_are_gone_go(spark, silver, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    monkeypatch.setattr(keyfilters, "FILTER_FILES", 2)
    monkeypatch.setattr(keyfilters, "LITERALS", 0)
    monkeypatch.setattr(keyfilters, "RATIO", 0)
    for k in range(5):
        upsert.upsert_transactions(spark, path, silver([1, k + 50], ingestion_hour=10 + k))
    filters = keyfilters.stored_filters(spark, path)
    assert len(tables.data_files(filters)) <= 3
    assert filters.select("file").distinct().count() <= len(table_files(spark, path)) + 2
    assert spark.read.parquet(path).count() == 6


def test_bloom_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 5000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        bits = keyfilters.bloom(keys)
        assert all(keyfilters.any_hit(bits, keys[k:k + 1]) for k in range(0, n, max(1, n // 50)))
        assert not keyfilters.any_hit(bits, rng.integers(0, 1 << 63, 1000).astype(np.uint64))
        assert 4 * n <= len(bits) <= max(512, 8 * n)

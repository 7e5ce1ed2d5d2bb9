"""The command line, from message files to gold."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgermill import jobs, schemas
from ledgermill.plans.daily import Lake
from ledgermill.sources import ledger, synth
from ledgermill.workspace import shared_root

FOLDER = "/root/testdata/sf0.001"


def test_jobs_from_files_to_gold(spark, tmp_path):
    lake, messages = Lake(str(tmp_path / "lake")), str(tmp_path / "messages")
    events = ledger.read_table(spark, FOLDER, "events")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    shift = F.lit(now).cast("timestamp_ntz") - F.lit(
        events.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    recent = events.withColumn("ts", F.col("ts") + shift)
    ledger.messages(recent).write.parquet(messages)
    ledger.customers(spark, FOLDER).write.parquet(lake.customers)

    def job(*arguments):
        return jobs.run(spark, ["--lake", lake.base, *arguments])

    for _ in range(2):
        job("ingest", "--files", messages, "--once")
    bronze = spark.read.schema(schemas.BRONZE).parquet(lake.bronze)
    assert bronze.count() == spark.read.parquet(messages).count()
    assert job("freshness") == 0
    before = set(os.listdir(shared_root(spark))) if os.path.isdir(shared_root(spark)) else set()
    today = bronze.agg(F.max("ingestion_date")).first()[0].isoformat()
    assert job("refine", "--process-date", today) == 0
    assert job("check", "--process-date", today) in (0, 1)
    assert job("gate", "--process-date", today) in (0, 1)
    assert job("gate", "--process-date", "2001-01-01") == 0
    assert job("gold", "--process-date", today) == 0
    silver = spark.read.schema(schemas.SILVER).parquet(lake.silver)
    assert silver.count() == silver.select("transaction_id").distinct().count() > 900
    assert spark.read.parquet(lake.gold("customer_analytics")).count() > 0
    # Working tables are gone.
    assert set(os.listdir(shared_root(spark))) <= before


def test_fault_rates(spark):
    code = F.format_string("T%08d", "id")
    clean = spark.range(20_000).select(
        code.alias("transaction_id"), code.alias("customer_id"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit("2024-01-30").cast("timestamp").alias("timestamp"))
    faulty = synth.inject_faults(clean)
    count = faulty.count()
    assert 20_000 * 1.01 < count < 20_000 * 1.03
    late = faulty.filter("_is_late_arrival = 'true'").count() / count
    broken = faulty.filter(
        "transaction_id IS NULL OR customer_id IS NULL OR amount IS NULL OR timestamp IS NULL"
    ).count() / count
    assert 0.04 < late < 0.06 and 0.005 < broken < 0.015

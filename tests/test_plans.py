"""Physical plans: what is pushed down, what is shuffled, what stays out of single tasks."""

import datetime as dt
import re

import pytest
from conftest import transaction
from pyspark.sql import functions as F

from ledgermill import catalog
from ledgermill.operators import clean, dedup, quality, trailing
from ledgermill.plans import customers as cust
from ledgermill.plans import lookups, risk
from ledgermill.plans import transactions as tx
from ledgermill.sources import scans
from ledgermill.workspace import new_path, stage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    """The silver table of the smallest data folder."""
    return catalog.tables_of(spark, "/root/testdata/sf0.001").silver


def test_payload_is_parsed_once(spark):
    bronze = spark.createDataFrame([], "raw_payload string, kafka_offset bigint, "
        "kafka_partition int, kafka_timestamp timestamp, ingestion_timestamp timestamp, "
        "ingestion_date date")
    path = new_path(spark, "bronze-plan")
    bronze.write.parquet(path)
    table = spark.read.schema(bronze.schema).parquet(path)
    assert plan(clean.clean_transactions(table)).count("from_json") == 1


def test_lookback_prunes_partitions_and_columns(silver):
    text = plan(tx.gold_transactions(silver, "2024-01-30"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ >= 2023-12-31", text)
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "transaction_id" not in schema and "raw_payload" not in schema


def test_status_filter_reaches_the_scan(silver):
    assert "Not(EqualTo(status,failed))" in plan(scans.not_failed(silver))


def test_dedup_cuts_copies_before_the_shuffle(silver):
    text = plan(dedup.dedup_latest(silver))
    assert text.index("Partial") > text.index("Exchange hashpartitioning(transaction_id")
    assert "WindowGroupLimit" in text


def test_customer_aggregate_does_not_expand_rows(silver):
    text = plan(cust.customer_core_agg(silver, "2024-01-30"))
    # Two levels each for values and sketches, then at most a broadcast.
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 4


def test_sketches_of_a_hot_group_are_merged_in_two_levels(silver):
    text = plan(tx.daily_by_type(silver))
    assert re.search(r"keys=\[event_date#\d+, transaction_type#\d+, currency#\d+, _salt#\d+\], "
                     r"functions=\[.*merge_percentile_approx", text)


def test_quality_report_scans_once(silver, spark):
    known = spark.createDataFrame([("a",)], "customer_id string")
    text = plan(quality.dq_report(silver, known, "2024-01-31"))
    assert text.count("FileScan") == 1


def test_rows_are_summed_before_dimension_joins(silver, spark):
    dims = stage(spark.createDataFrame(
        [("c", "n", "BR", "retail")], "customer_id string, name string, country string, "
        "segment string"), "dim")
    accounts = stage(spark.createDataFrame(
        [("a", "c", "savings")], "account_id string, customer_id string, account_type string"),
        "dim")
    for df in (risk.geo_anomalies(silver, dims), risk.currency_exposure(silver, dims),
               lookups.spend_by_account_type(silver, dims, accounts)):
        text = plan(df)
        # In the printed tree children follow parents: joins sit above the partial sums.
        assert text.index("Join") < text.index("partial_sum(amount") < text.index("FileScan")


def test_large_dimension_is_not_broadcast(silver, spark):
    """Beyond the size limit the same query sort-merges."""
    dims = stage(spark.createDataFrame(
        [("c", "BR")], "customer_id string, country string"), "dim")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(risk.geo_anomalies(silver, dims))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(risk.geo_anomalies(silver, dims))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scores_use_no_single_task_window(spark):
    rfm = stage(spark.range(10).select(
        F.col("id").cast("string").alias("customer_id"), F.col("id").cast("int").alias(
            "recency_days"), F.col("id").alias("frequency"),
        F.col("id").cast("decimal(28,2)").alias("monetary")), "rfm")
    text = plan(cust.rfm_scores(rfm))
    for window in re.findall(r"\bWindow \[.*", text):
        assert "ranking" in window, window
    assert "ntile" not in text


def test_trailing_windows_are_split_by_time(silver):
    text = plan(trailing.with_trailing_count(silver, "n"))
    for window in re.findall(r"\bWindow \[.*", text):
        assert "_slot" in window
    assert "partial_count(1)" in text


def run_with_small_skew(spark, df):
    """The plan that ran where partitions above a few kilobytes count as skewed."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        result = df()
        result.collect()
        return plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_customer_is_split(spark, silver):
    hot = F.when(F.col("kafka_offset") % 3 > 0, "HOT").otherwise(F.col("customer_id"))
    many = F.explode(F.array([F.lit(i) for i in range(20)]))
    rows = silver.withColumn("customer_id", hot).withColumn("_copy", many).drop("_copy")
    rows = stage(rows.repartition(16), "hot")
    text = run_with_small_skew(spark, lambda: risk.large_tx_flags(rows).select(
        "transaction_id", "amount", "risk_level"))
    assert "skew=true" in text


def test_rows_without_id_never_enter_the_join(spark):
    bronze = catalog.tables_of(spark, "/root/testdata/sf0.001").bronze
    parsed = stage(clean.parse_payload(bronze), "parsed")
    text = plan(clean.decision_tree(parsed))
    # The union's first branch is the join, over rows that pass all rules; its second is a scan.
    union, join = text.index("Union"), text.index("Join")
    assert union < join and text.count("Join") == 1
    accepted = text[join:text.index("FileScan", join)]
    assert re.search(r"Filter .*isnull\(trim\(transaction_id", accepted)


def test_one_wide_scan_for_all_granularities(silver):
    text = plan(tx.gold_transactions_union(silver, "2024-01-30"))
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    ledger_scans = [s for s in schemas_read if "amount:" in s or "merchant:" in s]
    # Beside the staged base: amounts for the sketches, merchants for the distinct count.
    assert len(ledger_scans) == 2
    assert sorted(s.count(":") for s in ledger_scans) == [2, 3]


def test_freshness_reads_the_last_days_only(spark):
    bronze = catalog.tables_of(spark, "/root/testdata/sf0.001").bronze
    table = stage(bronze, "bronze", "ingestion_date")
    text = plan(quality.bronze_freshness(table, "2024-01-31 00:00:00"))
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date#\d+ >= 2024-01-30", text)


def test_a_wide_frame_counts_the_lookback_only(frame):
    rows = [transaction(i, customer_id="C", timestamp=dt.datetime(2024, 1, 30) - dt.timedelta(i))
            for i in range(-3, 120)]
    df = frame(*rows).withColumn("event_date", F.to_date("timestamp"))
    core = cust.customer_core_agg(df, "2024-01-30").first()
    assert (core["total_transactions"], core["active_days"]) == (91, 91)


def test_hot_customer_results(frame, spark):
    """A customer with a third of all rows: same numbers as plain arithmetic."""
    rows = [transaction(i, i, customer_id="HOT" if i % 3 == 0 else f"C{i}", account_id=f"A{i % 2}")
            for i in range(300)]
    df = frame(*rows).withColumn("event_date", F.to_date("timestamp"))
    core = cust.customer_core_agg(df, "2024-01-30").filter("customer_id = 'HOT'").first()
    assert (core["total_transactions"], float(core["total_spend"]), core["active_days"],
            core["accounts_used"]) == (100, 1000.0, 1, 2)

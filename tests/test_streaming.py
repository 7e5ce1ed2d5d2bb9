"""Streams over several micro-batches against the batch results."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import clean, dedup
from ledgermill.plans import profile
from ledgermill.plans import transactions as tx
from ledgermill.sources import transport
from ledgermill.streaming import flows, velocity
from ledgermill.workspace import new_path

START = dt.datetime(2024, 1, 15)
MINUTE = dt.timedelta(minutes=1)


@pytest.fixture(scope="module")
def arrivals(spark):
    """300 transactions over two hours, out of order by up to ten minutes, some sent twice."""
    chance = random.Random(3)
    sent = []
    for i in range(300):
        event = START + dt.timedelta(seconds=i * 24)
        message = (f"TXN{i:04d}", "hot" if i % 3 == 0 else f"A{i % 7}", event)
        delay = dt.timedelta(seconds=chance.randrange(600))
        sent.append((event + delay, message))
        if i % 10 == 0:
            sent.append((event + delay + MINUTE, message))
    sent.sort()
    return [
        (account.encode(), (
            f'{{"transaction_id":"{txn}","account_id":"{account}","customer_id":"C",'
            f'"transaction_type":"purchase","amount":5,"currency":"USD","status":"completed",'
            f'"timestamp":"{event.isoformat()}"}}').encode(), "t", 0, offset, arrival)
        for offset, (arrival, (txn, account, event)) in enumerate(sent)
    ]


@pytest.fixture(scope="module")
def folder(spark, arrivals):
    """The messages in eight files, in order of arrival."""
    path = new_path(spark, "arrivals")
    size = -(-len(arrivals) // 8)
    for start in range(0, len(arrivals), size):
        part = spark.createDataFrame(arrivals[start:start + size], schemas.TRANSPORT)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder, files=1):
    messages = transport.file_stream(spark, folder, files_per_trigger=files)
    return transport.bronze_project(messages, F.col("timestamp"))


def land(spark, streaming, partition_by=None):
    path = new_path(spark, "out")
    flows.run_available(
        spark, flows.parquet_sink(streaming, new_path(spark, "checkpoint"), partition_by), path)
    return spark.read.schema(streaming.schema).parquet(path)


@pytest.fixture(scope="module")
def bronze(spark, folder):
    return transport.bronze_project(spark.read.parquet(folder), F.col("timestamp"))


def rows(df):
    return Counter(map(str, df.select(sorted(df.columns)).collect()))


def test_bronze_equals_batch_and_restarts_exactly_once(spark, folder, bronze):
    path, checkpoint = new_path(spark, "bronze"), new_path(spark, "checkpoint")
    for _ in range(2):
        flows.run_available(spark, flows.bronze_sink(stream(spark, folder, 3), checkpoint), path)
    assert rows(spark.read.schema(bronze.schema).parquet(path)) == rows(bronze)


def test_default_ingestion_time_is_now(spark, folder):
    stamped = transport.bronze_project(spark.read.parquet(folder))
    age = F.current_timestamp() - F.col("ingestion_timestamp")
    assert stamped.filter(age > F.expr("interval 1 hour")).count() == 0


def test_dedup_within_watermark(spark, folder, bronze):
    ids = land(spark, flows.deduplicated(flows.cleaned(stream(spark, folder)))
               .select("transaction_id"))
    assert ids.count() == ids.distinct().count() == 300


@pytest.fixture(scope="module")
def disorder(spark, arrivals):
    """The same messages dealt to six files by offset, so that every file brings early events
    hours behind what earlier triggers have seen; one id comes once, last and very late."""
    path = new_path(spark, "disorder")
    for k in range(6):
        part = arrivals[k::6]
        if k == 5:
            key, value, topic, partition, _, arrival = arrivals[0]
            value = re.sub(rb"TXN\d+", b"LATE001", value).replace(b"2024-01-15T", b"2024-01-14T")
            part = [*part, (key, value, topic, partition, 10_000, arrival)]
        spark.createDataFrame(part, schemas.TRANSPORT).coalesce(1).write.mode("append").parquet(path)
    return path


def test_no_id_is_lost_however_late(spark, disorder):
    path, checkpoint = new_path(spark, "first"), new_path(spark, "checkpoint")
    for _ in range(2):
        flows.run_available(
            spark, flows.first_deliveries_sink(stream(spark, disorder), path, checkpoint))
    batch = transport.bronze_project(spark.read.parquet(disorder), F.col("timestamp"))
    wanted = dedup.dedup_latest(clean.clean_transactions(batch)).select("transaction_id")
    landed = spark.read.parquet(path).select("transaction_id")
    assert rows(landed) == rows(wanted) and wanted.count() == 301


def delayed(bronze):
    """Every fifth message arrives forty minutes later than it did."""
    arrival = F.col("ingestion_timestamp")
    late = F.col("kafka_offset") % 5 == 0
    return bronze.withColumn("ingestion_timestamp", F.when(
        late, arrival + F.expr("interval 40 minutes")).otherwise(arrival))


def test_late_rows_are_routed_not_dropped(spark, folder, bronze):
    path = new_path(spark, "late")
    silver = flows.cleaned(delayed(stream(spark, folder)))
    flows.run_available(spark, flows.late_split_sink(silver, new_path(spark, "checkpoint")), path)
    landed = spark.read.schema(silver.schema).parquet(path)
    counts = dict(map(tuple, landed.groupBy("is_late_arrival").count().collect()))
    assert counts == {True: 66, False: 264}


def closed_before(bronze):
    latest = clean.clean_transactions(bronze).agg(F.max("timestamp")).first()[0]
    return latest - 30 * MINUTE


def test_hourly_volume_of_closed_hours(spark, folder, bronze):
    streamed = land(spark, flows.hourly_volume(
        flows.deduplicated(flows.cleaned(stream(spark, folder)))))
    batch = tx.hourly_volume(dedup.dedup_latest(clean.clean_transactions(bronze)))
    closed = batch.filter(F.col("hour") + F.expr("interval 1 hour") <= F.lit(closed_before(bronze)))
    assert closed.count() > 0
    assert rows(streamed) == rows(closed.drop("granularity"))


def test_velocity_with_disorder_over_many_batches(spark, folder, bronze, arrivals):
    streamed = land(spark, velocity.trailing_counts(
        flows.deduplicated(flows.cleaned(stream(spark, folder)))))
    silver = dedup.dedup_latest(clean.clean_transactions(bronze)).collect()
    limit = closed_before(bronze)
    epoch = dt.datetime(1970, 1, 1)
    events = [(r["account_id"], int((r["timestamp"] - epoch).total_seconds())) for r in silver]
    last = int((limit - epoch).total_seconds())
    expected = {
        (account, second, sum(1 for a, s in events if a == account and 0 <= second - s <= 600))
        for account, second in events if second + 1 <= last
    }
    assert set(map(tuple, streamed.collect())) == expected
    assert max(count for *_, count in expected) > 5


def test_flags_exceed_the_limit(spark, folder):
    flags = land(spark, velocity.velocity_flags(flows.cleaned(stream(spark, folder)), limit=7))
    assert flags.filter("trailing_count <= 7").count() == 0 and flags.count() > 0


def test_upsert_per_batch_equals_batch_dedup(spark, folder, bronze):
    path, checkpoint = new_path(spark, "upsert"), new_path(spark, "checkpoint")
    flows.run_available(spark, flows.upsert_sink(stream(spark, folder, 2), path, checkpoint))
    columns = ["transaction_id", "status", "ingestion_timestamp", "event_date"]
    merged = spark.read.parquet(path).select(*columns)
    assert rows(merged) == rows(
        dedup.dedup_latest(clean.clean_transactions(bronze)).select(*columns))


def test_running_tallies(spark, folder, bronze):
    tallies = profile.tally(stream(spark, folder, 2))
    writer = tallies.writeStream.outputMode("complete").format("memory").queryName("tallies")
    flows.run_available(spark, writer.option("checkpointLocation", new_path(spark, "checkpoint")))
    assert rows(spark.table("tallies")) == rows(profile.tally(bronze))


def silver_of(spark, folder):
    bronze = transport.bronze_project(spark.read.parquet(folder), F.col("timestamp"))
    return dedup.dedup_latest(clean.clean_transactions(bronze))


def hourly_rows(df):
    return rows(df.withColumn("total_volume", F.col("total_volume").cast("decimal(28,2)")))


def test_hourly_corrections_reach_closed_hours(spark, disorder, monkeypatch):
    """Early events come hours behind, in every trigger, and every trigger's totals are silver's."""
    monkeypatch.setattr(flows.additive, "FOLD", 1)
    silver, hourly, checkpoint = (new_path(spark, n) for n in ("silver", "hourly", "checkpoint"))
    for _ in range(2):
        flows.run_available(spark, flows.hourly_sink(stream(spark, disorder, 2), silver, hourly, checkpoint))
        want = tx.hourly_volume(silver_of(spark, disorder)).drop("granularity")
        assert hourly_rows(flows.hourly_totals(spark, hourly)) == hourly_rows(want)


def changed(bronze, hours, amount):
    """The same messages again, so many hours later and with another amount."""
    later = F.col("ingestion_timestamp") + F.make_dt_interval(hours=F.lit(hours))
    return bronze.withColumns({
        "raw_payload": F.replace("raw_payload", F.lit('"amount":5'), F.lit(f'"amount":{amount}')),
        "ingestion_timestamp": later})


def test_repeated_batches_and_updates_of_past_hours(spark, bronze, monkeypatch):
    silver, hourly = new_path(spark, "silver"), new_path(spark, "hourly")
    first, again = bronze.filter("kafka_offset < 200"), changed(bronze.filter("kafka_offset < 120"), 5, 8)

    def check():
        table = spark.read.schema(schemas.SILVER).parquet(silver)
        want = tx.hourly_volume(table).drop("granularity")
        assert hourly_rows(flows.hourly_totals(spark, hourly)) == hourly_rows(want)

    flows.merge_hourly(first, 0, silver, hourly)
    check()
    flows.merge_hourly(first, 0, silver, hourly)
    check()
    # The batch's changes are noted, then the merge fails; the batch is repeated.
    with monkeypatch.context() as broken:
        broken.setattr(flows, "upsert_transactions", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            flows.merge_hourly(again, 1, silver, hourly)
    flows.merge_hourly(again, 1, silver, hourly)
    check()
    flows.merge_hourly(again, 1, silver, hourly)
    flows.merge_hourly(bronze.filter("kafka_offset >= 200"), 2, silver, hourly)
    check()
    amounts = {float(r[0]) for r in spark.read.parquet(silver).select("amount").distinct().collect()}
    assert amounts == {5.0, 8.0}


def test_folding_counts_nothing_twice(spark):
    from ledgermill.streaming import additive

    path, shape = new_path(spark, "sums"), ("k string, n bigint", ["k"], ["n"])
    for number in range(5):
        rows_ = spark.createDataFrame([("a", 1), ("b", number), ("c", 1 if number else -4)], "k string, n bigint")
        for _ in range(2):
            additive.add_batch(rows_, path, number)
        additive.fold(spark, path, *shape, most=2)
    got = {r["k"]: r["n"] for r in additive.totals(spark, path, *shape).collect()}
    assert got == {"a": 5, "b": 10}
    assert additive.counted(spark, path, 1) and not additive.counted(spark, path, 5)


def test_tallies_add_up_over_triggers(spark, folder, bronze):
    path, checkpoint = new_path(spark, "tallies"), new_path(spark, "checkpoint")
    for _ in range(2):
        flows.run_available(spark, flows.tally_sink(stream(spark, folder, 3), path, checkpoint))
    assert rows(flows.tallies(spark, path)) == rows(profile.tally(bronze))


def test_an_idle_account_leaves_no_state(spark):
    """One account stops; hours later its state is gone while the other's is still there."""
    path, checkpoint = new_path(spark, "idle"), new_path(spark, "checkpoint")
    for k in range(8):
        event = START + dt.timedelta(minutes=20 * k)
        accounts = ["idle", "busy"] if k < 2 else ["busy"]
        sent = [(a.encode(), (
            f'{{"transaction_id":"{a}{k}{n}","account_id":"{a}","customer_id":"C","transaction_type":"purchase",'
            f'"amount":5,"currency":"USD","status":"completed","timestamp":"{event.isoformat()}"}}').encode(),
            "t", 0, 10 * k + n, event) for a in accounts for n in range(2)]
        spark.createDataFrame(sent, schemas.TRANSPORT).coalesce(1).write.mode("append").parquet(path)
    out = new_path(spark, "out")
    counts = velocity.trailing_counts(flows.cleaned(stream(spark, path)), seconds=1800)
    flows.run_available(spark, flows.parquet_sink(counts, checkpoint), out)
    got = {(r["account_id"], r["second"]): r["trailing_count"] for r in spark.read.parquet(out).collect()}
    epoch = int((START - dt.datetime(1970, 1, 1)).total_seconds())
    assert got == {("idle", epoch): 2, ("idle", epoch + 1200): 4, ("busy", epoch): 2} | {
        ("busy", epoch + 1200 * k): 4 for k in range(1, 6)}
    state = spark.read.format("statestore").option("stateVarName", "recent").option("operatorId", 0).load(checkpoint)
    assert {r["key"][0] for r in state.select("key").collect()} == {"busy"}


def test_trailing_sums():
    import numpy as np
    sums = velocity.trailing_sums(np.array([0, 5, 10, 11]), np.array([1, 2, 3, 4]), 10)
    assert sums.tolist() == [1, 3, 6, 9]


def test_kafka_options():
    options = transport.kafka_options("broker:9092", "topic")
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options
    options = transport.kafka_options("b", "t", max_offsets=7, fail_on_data_loss=False)
    assert (options["maxOffsetsPerTrigger"], options["failOnDataLoss"]) == ("7", "false")


def test_keyed_json(spark):
    sent = transport.keyed_json(spark.createDataFrame(
        [("A", 1), (None, 2)], "account_id string, n int"))
    assert sorted(map(tuple, sent.collect())) == [
        ("A", '{"account_id":"A","n":1}'), ("unknown", '{"n":2}')]


def test_messages_of_an_account_come_in_event_order(spark, bronze):
    """A hot account takes several rounds; rows of one account never overtake each other."""
    silver = dedup.dedup_latest(clean.clean_transactions(bronze))
    sent = transport.ordered_json(silver.select("account_id", "transaction_id", "timestamp"))
    out, place = [], {}
    rounds = transport.send_in_order(sent, "key", "seq", lambda df: out.extend(
        df.select("key", "seq", F.get_json_object("value", "$.transaction_id").alias("id")).collect()), most=30)
    assert rounds == 4 and len(out) == 300
    wanted = {}
    for r in sorted(silver.collect(), key=lambda r: (r["timestamp"], r["transaction_id"])):
        wanted.setdefault(r["account_id"], []).append(r["transaction_id"])
    for r in out:
        place.setdefault(r["key"], []).append((r["seq"], r["id"]))
    assert {k: [i for _, i in v] for k, v in place.items()} == wanted
    assert all([n for n, _ in v] == list(range(1, len(v) + 1)) for v in place.values())

"""Streams and merges whose tasks do not grow with the messages."""

import numpy as np
from pyspark.sql import functions as F

from ledgermill import catalog
from ledgermill.operators import upsert
from ledgermill.streaming import flows, velocity
from ledgermill.workspace import new_path, stage
from silver_rows import silver_rows

SMALLEST = "/root/testdata/sf0.001"


def test_messages_come_in_three_triggers_of_more_files_where_there_are_more(spark, monkeypatch):
    read, sizes = catalog.transport.file_stream, []

    def file_stream(session, path, **options):
        written = session.read.parquet(path)
        sizes.append((len(written.inputFiles()), options["files_per_trigger"], written.count()))
        return read(session, path, **options)

    monkeypatch.setattr(catalog.transport, "file_stream", file_stream)
    for most in (200_000, 10):
        monkeypatch.setattr(catalog, "FILE_MESSAGES", most)
        catalog.late_messages(catalog.tables_of(spark, SMALLEST))
    (few, one, n), (many, some, same) = sizes
    assert (few, one) == (3, 1) and n == same
    assert some > 1 and 2 * some < many <= 3 * some


def test_a_merge_writes_a_staged_batch_no_second_time(spark, monkeypatch):
    path, names = new_path(spark, "merged"), []
    real = upsert.stage
    monkeypatch.setattr(upsert, "stage", lambda df, name, *a: names.append(name) or real(df, name, *a))
    upsert.upsert_transactions(spark, path, silver_rows(spark, range(300)))
    batch = stage(silver_rows(spark, range(200, 400), 13, "failed"), "batch")
    found = upsert.upsert_transactions(spark, path, batch, staged=True)
    assert found == {"insert": 100, "update": 100, "duplicate": 0} and names == ["known"]
    assert spark.read.parquet(path).groupBy("status").count().orderBy("status").collect() == [
        ("completed", 200), ("failed", 200)]


def test_a_streamed_merge_does_not_stage_the_silver_of_the_folder(spark, monkeypatch):
    def unread(_):
        raise AssertionError("silver was built")

    monkeypatch.setattr(catalog.Tables, "silver", property(unread))
    t = catalog.Tables(spark, SMALLEST)
    assert catalog.stream_dedup_intent(t).count() == t.cleaned.select("transaction_id").distinct().count()


class Handle:
    """The calls of a processor, counted, on a dict."""

    def __init__(self):
        self.calls, self.value, self.timers = [], None, set()

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        self.calls.append("list")
        return iter(self.timers)

    def deleteTimer(self, at):
        self.calls.append("delete")
        self.timers.remove(at)

    def registerTimer(self, at):
        self.calls.append("register")
        self.timers.add(at)


def test_an_account_costs_few_calls_and_has_one_timer():
    import pandas as pd

    handle, processor = Handle(), velocity.TrailingCount(10)
    processor.init(handle)
    frame = lambda *pairs: pd.DataFrame(pairs, columns=["second", "n"])
    first = next(processor.handleInputRows(("a",), iter([frame((7, 1), (5, 2)), frame((5, 1))]), None))
    assert first.values.tolist() == [["a", 5, 3], ["a", 7, 4]]
    assert handle.calls == ["get", "update", "register"] and handle.timers == {18_000}
    second = next(processor.handleInputRows(("a",), iter([frame((16, 1))]), None))
    assert second.values.tolist() == [["a", 16, 2]] and handle.timers == {27_000}
    assert handle.calls[3:] == ["get", "update", "delete", "register"]
    assert [list(x) for x in handle.value] == [[7, 16], [1, 1]]
    assert list(processor.handleExpiredTimer(("a",), None, None)) == [] and handle.value is None


def test_seconds_are_summed_in_order():
    found, counts = velocity.summed(np.array([3, 1, 3]), np.array([1, 2, 4]))
    assert found.tolist() == [1, 3] and counts.tolist() == [2, 5]

"""Exact trailing counts on a stream.

Built-in aggregation first reduces the stream to closed (account, second) counts. It merges
map-side, so a hot account is one row per task and second, and it tolerates any disorder within
the watermark. What it emits is final and only moves forward in time, so the stateful step that
follows keeps, per account, the counts of one window. An event-time timer drops them once the
watermark has passed the last second's window: accounts that fall silent leave no state behind,
and no count that is still to come could have used it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgermill.functions.measures import rows
from ledgermill.plans.risk import VELOCITY_LIMIT, VELOCITY_SECONDS

OUTPUT = "account_id string, second bigint, trailing_count bigint"
STATE = "seconds array<bigint>, counts array<bigint>"

# Ship this module's code with the query, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trailing_sums(seconds: np.ndarray, counts: np.ndarray, span: int) -> np.ndarray:
    """For ascending seconds: sum of counts in the closed range ``[second - span, second]``."""
    running = np.concatenate(([0], np.cumsum(counts)))
    first = np.searchsorted(seconds, seconds - span, side="left")
    return running[1:] - running[first]


def summed(seconds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending seconds, each once, with the sums of their counts."""
    found, at = np.unique(seconds, return_inverse=True)
    out = np.zeros(len(found), "int64")
    np.add.at(out, at, counts)
    return found, out


class TrailingCount(StatefulProcessor):
    """Counts of one account; a batch brings one row per second the watermark has closed."""

    def __init__(self, span: int):
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # Few calls to the state, as each is a round trip: one read, one write, at most two timers.
        parts = [(b["second"].to_numpy("int64"), b["n"].to_numpy("int64")) for b in rows]
        new_seconds, new_counts = summed(*map(np.concatenate, zip(*parts)))
        stored = self.recent.get()
        known = stored if stored is not None else ([], [])
        seconds = np.concatenate((np.asarray(known[0], "int64"), new_seconds))
        counts = np.concatenate((np.asarray(known[1], "int64"), new_counts))
        sums = trailing_sums(seconds, counts, self.span)
        keep = seconds >= seconds[-1] - self.span
        self.recent.update((seconds[keep].tolist(), counts[keep].tolist()))
        # An account has one timer, that of the last second it has counts of.
        if len(known[0]):
            self.handle.deleteTimer(self.expiry(known[0][-1]))
        self.handle.registerTimer(self.expiry(seconds[-1]))
        yield pd.DataFrame({
            "account_id": key[0], "second": new_seconds, "trailing_count": sums[len(known[0]):],
        })

    def expiry(self, last_second: int) -> int:
        """Counts of the last second and earlier end in windows up to ``span`` seconds later."""
        return int(last_second + self.span + 1) * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing_counts(transactions: DataFrame, seconds: int = VELOCITY_SECONDS) -> DataFrame:
    """Per account and closed second: transactions in the trailing ``seconds``."""
    per_second = (
        transactions.groupBy("account_id", F.window("timestamp", "1 second").alias("window"))
        .agg(rows().alias("n"))
        .select("account_id", "n", F.window_time("window").alias("at"))
        .withColumn("second", F.col("at").cast("bigint"))
    )
    return per_second.groupBy("account_id").transformWithStateInPandas(
        statefulProcessor=TrailingCount(seconds), outputStructType=OUTPUT, outputMode="Append",
        timeMode="EventTime",
    )


def velocity_flags(
    transactions: DataFrame, seconds: int = VELOCITY_SECONDS, limit: int = VELOCITY_LIMIT
) -> DataFrame:
    """Seconds in which an account exceeds the limit, as soon as they are final."""
    return trailing_counts(transactions, seconds).filter(F.col("trailing_count") > limit)

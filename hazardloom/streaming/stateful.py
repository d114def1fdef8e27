"""Streams with typed state and timers: a feed of changes with keepalive, silent sources, and first-ever latches.

These need a state store that keeps several values per key, as RocksDB does (``use_rocksdb``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEEPALIVE_S = 3600


def use_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


class ChangeFeed(StatefulProcessor):
    """Per key what changed since it was last emitted, what was last emitted ``keepalive_s`` ago, and when a key fell silent.

    The last emitted row is a value state that is forgotten after ``forget_s`` without rows. Each emission sets a timer
    ``silent_s`` later in event time, in place of the one before; when it fires, no row came since, and a row of kind
    ``silent`` says so, once. Rows that are older than the last emitted one are late and passed over.
    """

    def __init__(self, key: str, keepalive_s: int, silent_s: int, forget_s: int):
        self.key, self.keepalive_s, self.silent_s, self.forget_s = key, keepalive_s, silent_s, forget_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = self.forget_s * 1000 if self.forget_s else None
        self.last = handle.getValueState("last", "at long, level string", ttl)
        self.seen = handle.getValueState("seen", "at long", ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, seen, out = self.last.get(), self.seen.get(), []
        newest = seen[0] if seen else None
        for batch in [pd.concat(list(rows)).sort_values(["at", "tie"])]:
            for at, level in zip(batch["at"].astype("int64"), batch["level"], strict=True):
                at = int(at)
                newest = at if newest is None else max(newest, at)
                if last is not None and at < last[0]:
                    continue
                if last is None or level != last[1] or at - last[0] >= self.keepalive_s:
                    out.append((key[0], at, level, "first" if last is None else "change" if level != last[1] else "keepalive"))
                    last = (at, level)
        self.last.update(last)
        self.seen.update((newest,))
        if self.silent_s:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((newest + self.silent_s) * 1000)
        yield pd.DataFrame(out, columns=[self.key, "at", "level", "kind"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()
        if last is not None:
            yield pd.DataFrame([(key[0], expiredTimerInfo.getExpiryTimeInMs() // 1000, last[1], "silent")], columns=[self.key, "at", "level", "kind"])

    def close(self) -> None:
        pass


def change_feed(stream: DataFrame, key: str, at: str, level: str, tie: str, delay: str, keepalive_s: int = KEEPALIVE_S, silent_s: int = 0, forget_s: int = 0) -> DataFrame:
    """``key, at, level, kind`` (first, change, keepalive or silent) of a stream; ``at`` is its event time, a timestamp.

    Rows of a batch are taken in order of time and ``tie``. ``delay`` is how late rows may be before a timer can fire.
    """
    timed = stream.withWatermark(at, delay)
    rows = timed.select(key, F.col(at).alias("event_time"), F.unix_timestamp(at).alias("at"), F.col(tie).alias("tie"), F.col(level).alias("level"))
    kind = dict(stream.dtypes)[key]
    return rows.groupBy(key).transformWithStateInPandas(ChangeFeed(key, keepalive_s, silent_s, forget_s), f"{key} {kind}, at long, level string, kind string", "Append", "EventTime" if silent_s else ("ProcessingTime" if forget_s else "None"))


class FirstLatch(StatefulProcessor):
    """The first row ever of each key, by time within the batch that brings it, and never again."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, n = None, 0
        for batch in rows:
            least = int(batch["at"].min())
            at, n = least if at is None else min(at, least), n + len(batch)
        first = not self.first.exists()
        if first:
            self.first.update((at,))
        yield pd.DataFrame([(key[0], at, n, first)], columns=[self.key, "at", "n", "first"])

    def close(self) -> None:
        pass


def first_latch(stream: DataFrame, key: str, at: str) -> DataFrame:
    """``key, at, n, first`` of each batch's keys: how many rows came, and whether the key was never seen before."""
    kind = dict(stream.dtypes)[key]
    rows = stream.select(key, F.unix_timestamp(at).alias("at"))
    return rows.groupBy(key).transformWithStateInPandas(FirstLatch(key), f"{key} {kind}, at long, n long, first boolean", "Append", "None")

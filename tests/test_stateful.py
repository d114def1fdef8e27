from datetime import datetime, timedelta, timezone

import pytest

from hazardloom.plans.published import batch_sink, read_batches
from hazardloom.streaming import stateful

BEGIN = datetime(2026, 9, 27, tzinfo=timezone.utc)
FEED = "station long, at long, level string, kind string"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    stateful.use_rocksdb(spark)
    yield spark
    spark.conf.unset(name)


def _put(spark, folder, n, rows):
    table = [(k, BEGIN + timedelta(seconds=s), level, i) for i, (k, s, level) in enumerate(rows)]
    spark.createDataFrame(table, "station long, at timestamp, level string, tie long").coalesce(1).write.mode("append").parquet(f"{folder}/{n}")


def _feed(spark, folder, work, make):
    stream = spark.readStream.schema("station long, at timestamp, level string, tie long").parquet(f"{folder}/*")
    make(stream).writeStream.foreachBatch(batch_sink(f"{work}/out")).option("checkpointLocation", f"{work}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()


def test_change_feed_keeps_its_state_over_restarts_and_tells_of_silence(rocks, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path)
    make = lambda s: stateful.change_feed(s, "station", "at", "level", "tie", "0 seconds", keepalive_s=60, silent_s=100)
    steps = [
        [(1, 0, "low"), (1, 10, "low"), (1, 20, "high"), (2, 0, "low")],
        [(1, 30, "high"), (1, 79, "high"), (1, 80, "high"), (1, 90, "low"), (1, 15, "late")],
        [(1, 300, "low")],  # station 2 has been silent since 0, station 1 since 90
        [(1, 301, "low"), (2, 302, "low"), (1, 400, "low")],
        [(3, 1000, "x")],
    ]
    for n, rows in enumerate(steps):
        _put(rocks, folder, n, rows)
        _feed(rocks, folder, work, make)  # each step is a restart
    base = int(BEGIN.timestamp())
    got = sorted((r.station, r.at - base, r.level, r.kind) for r in read_batches(rocks, f"{work}/out", FEED).collect())
    assert [g for g in got if g[0] == 1 and g[3] != "silent"] == [(1, 0, "low", "first"), (1, 20, "high", "change"), (1, 80, "high", "keepalive"), (1, 90, "low", "change"), (1, 300, "low", "keepalive"), (1, 400, "low", "keepalive")]
    assert [g for g in got if g[0] == 2] == [(2, 0, "low", "first"), (2, 100, "low", "silent"), (2, 302, "low", "keepalive"), (2, 402, "low", "silent")]
    assert [g for g in got if g[0] == 1 and g[3] == "silent"][-1] == (1, 500, "low", "silent")


def test_change_feed_agrees_with_the_batch_fold(rocks, tmp_path):
    import random

    from hazardloom.streaming.change_only import emitted

    rng = random.Random(4)
    rows = [(k, 10 * i + rng.randrange(9), rng.choice("ab")) for k in range(3) for i in range(60)]
    folder, work = str(tmp_path / "in"), str(tmp_path)
    for n in range(3):
        _put(rocks, folder, n, [r for r in rows if n * 200 <= r[1] < n * 200 + 200])
        _feed(rocks, folder, work, lambda s: stateful.change_feed(s, "station", "at", "level", "tie", "0 seconds", keepalive_s=45))
    got = {(r.station, r.at, r.level) for r in read_batches(rocks, f"{work}/out", FEED).collect()}
    base = int(BEGIN.timestamp())
    table = rocks.createDataFrame([(k, s + base, level, 0) for k, s, level in rows], "station long, at long, level string, tie long")
    assert got == {(r.station, r["at"], r.level) for r in emitted(table, "station", "at", "level", "tie", 45).collect()}


def test_first_latch_is_set_once_over_restarts(rocks, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path)
    make = lambda s: stateful.first_latch(s, "station", "at")
    for n, rows in enumerate([[(1, 5, "x"), (1, 2, "x"), (2, 9, "x")], [(1, 1, "x"), (3, 4, "x")], [(2, 0, "x"), (3, 1, "x"), (3, 2, "x")]]):
        _put(rocks, folder, n, rows)
        _feed(rocks, folder, work, make)
    base = int(BEGIN.timestamp())
    got = sorted((r.batch, r.station, r["at"] - base, r.n, r.first) for r in read_batches(rocks, f"{work}/out", "station long, at long, n long, first boolean").collect())
    assert [g[1:] for g in got] == [(1, 2, 2, True), (2, 9, 1, True), (1, 1, 1, False), (3, 4, 1, True), (2, 0, 1, False), (3, 1, 2, False)]

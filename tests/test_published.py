import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hazardloom.plans import published
from hazardloom.sources import landed

SCHEMA = "k long, at string, v string"


def _months(spark, path):
    return sorted((r.k, r.v) for r in published.read_months(spark, path, SCHEMA).collect())


def test_a_month_that_shrinks_is_refused_and_the_others_are_published(spark, tmp_path):
    path = str(tmp_path / "quakes")
    table = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = [(i, f"2024-0{1 + i % 3}-0{1 + i % 9}", "old") for i in range(90)]
    ok, report = published.publish_months(table(first), path, "at")
    assert ok and [(r["month"], r["n_old"], r["n_new"], r["changed"]) for r in report] == [(f"2024-0{m}", 0, 30, 30) for m in (1, 2, 3)]
    second = [(k, at, "new" if at < "2024-02" else v) for k, at, v in first if at < "2024-03" and not ("2024-02" <= at < "2024-03" and k > 60)] + [(100, "2024-04-01", "new")]
    ok, report = published.publish_months(table(second), path, "at")
    assert not ok and {r["month"]: r["replaced"] for r in report} == {"2024-01": True, "2024-02": False, "2024-04": True}
    want = sorted((k, "new" if at < "2024-02" else "old") for k, at, v in first) + [(100, "new")]
    assert _months(spark, path) == want
    before = published.Manifests(spark, path).newest()
    ok, report = published.publish_months(table([(100, "2024-04-01", "new")]), path, "at")
    assert ok and report[0]["changed"] == 0 and published.Manifests(spark, path).newest() == before  # nothing changed, nothing written
    assert published.publish_months(table([]), path, "at") == (True, []) and _months(spark, path) == want
    assert published.drop_months(spark, path, "2024-03") == ["2024-01", "2024-02"] and _months(spark, path) == [x for x in want if x[0] % 3 == 2 and x[0] < 90 or x[0] == 100]


def test_readers_see_the_step_before_until_the_manifest_is_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "quakes")
    rows = spark.createDataFrame([(1, "2024-01-01", "a")], SCHEMA)
    published.publish_months(rows, path, "at")
    with monkeypatch.context() as m:
        m.setattr(published.Manifests, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            published.publish_months(rows.withColumn("v", F.lit("b")), path, "at")
    assert _months(spark, path) == [(1, "a")]
    published.publish_months(rows.withColumn("v", F.lit("b")), path, "at")
    assert _months(spark, path) == [(1, "b")]
    table = published.Manifests(spark, path)
    number, now = table.newest()
    table.commit(number, now)
    with pytest.raises(Exception):  # another writer was faster
        table.commit(number, now)
    assert not [n for n in table.files.names("_manifests") if n.endswith(".part")]


def test_state_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "state" / "quakes.json")
    for n in (1, 2):
        published.put_state(spark, path, {"last_fetch": "x", "n": n, "note": "é"})
        assert json.loads((tmp_path / "state" / "quakes.json").read_text()) == {"last_fetch": "x", "n": n, "note": "é"}
    assert [p.name for p in (tmp_path / "state").iterdir() if not p.name.endswith(".crc")] == ["quakes.json"]


def _land(root, source, time, body, kind="html"):
    (root / source).mkdir(parents=True, exist_ok=True)
    (root / source / f"{time.strftime('%Y%m%dT%H%M%S%fZ')}.{kind}").write_text(body)


def _run(spark, root, sink, checkpoint):
    stream = spark.readStream.format("landed_pages").option("path", str(root)).option("settle", "0").option("files", "3").load()
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()


def test_landed_pages_arrive_once_over_restarts_and_failures(spark, tmp_path):
    landed.register(spark)
    root, out, checkpoint = tmp_path / "pages", str(tmp_path / "out"), tmp_path / "checkpoint"
    begin = datetime.now(timezone.utc) - timedelta(hours=1)
    for i in range(10):
        _land(root, f"source{i % 2}", begin + timedelta(seconds=i), f"page {i}")
    _land(root, "source0", begin + timedelta(days=30), "from the future")
    (root / "source0" / "notes.txt").write_text("no page")
    batch = spark.read.format("landed_pages").option("path", str(root)).option("settle", "0").load()
    assert sorted(r.body for r in batch.collect()) == sorted(f"page {i}" for i in range(10))
    assert {r.source for r in batch.collect()} == {"source0", "source1"} and batch.agg(F.min("landed")).first()[0] is not None
    _run(spark, root, published.batch_sink(out), checkpoint)
    read = lambda: sorted(r.body for r in published.read_batches(spark, out, landed.SCHEMA).collect())
    assert read() == sorted(f"page {i}" for i in range(10))
    _land(root, "source2", begin + timedelta(minutes=30), "late landed but older than now")
    for i in range(10, 14):
        _land(root, "source0", datetime.now(timezone.utc), f"page {i}")

    def killed(batch_id):
        raise RuntimeError("killed between staging and commit")

    with pytest.raises(StreamingQueryException):
        _run(spark, root, published.batch_sink(out, killed), checkpoint)
    assert len(read()) == 10  # staged, not published
    _run(spark, root, published.batch_sink(out), checkpoint)
    assert read() == sorted(f"page {i}" for i in range(14))
    _run(spark, root, published.batch_sink(out), checkpoint)
    assert len(read()) == 14


def test_a_batch_that_comes_again_is_passed_over(spark, tmp_path):
    sink, path = published.batch_sink(str(tmp_path / "t")), str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([(v,)], "v long")
    assert published.read_batches(spark, path, "v long").count() == 0
    for v, batch_id in ((1, 0), (2, 1), (99, 1), (98, 0)):
        sink(rows(v), batch_id)
    assert sorted((r.v, r.batch) for r in published.read_batches(spark, path, "v long").collect()) == [(1, 0), (2, 1)]

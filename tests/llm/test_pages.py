import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from hazardloom.llm import warc
from hazardloom.llm.url_filter import filter_urls

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("block", "net", "/de/"), ("block", "b.com", "/"), ("allow", "b.com", "/"), ("allow", None, "/"), ("block", "", "/")]


def _brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_url_filter_matches_brute_force(spark):
    urls = [None, "", "nothing", "http://", "http://A.Example.COM/en/71?x", "https://example.com/en/8#y", "http://xcom/en/1", "http://com/en/", "http://a.net/de/1", "http://b.com", "http://x.b.com/q", "http://É.net/de/", "ftp://a..com/en/" + "z" * 5000, "http://example.com?/en/7", "http://h/a://b"]
    urls += [f"http://h{i % 7}.{'example.' * (i % 2)}{('com', 'net', 'org')[i % 3]}/{('en', 'de')[i % 2]}/{i % 9}" for i in range(600)] + ["http://hot.com/en/7"] * 400
    pages = spark.createDataFrame([(i, u, "path") for i, u in enumerate(urls)], "page_id long, url string, path string")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, rules).collect()}
    assert got == {i: _brute(u, RULES) for i, u in enumerate(urls)}


def test_url_filter_repeated_and_empty(spark):
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    schema = "page_id long, url string"
    assert filter_urls(spark.createDataFrame([], schema), rules).count() == 0
    assert filter_urls(spark.createDataFrame([(1, "http://a.com/en/"), (1, "http://a.com/en/"), (None, None)], schema), rules).count() == 3
    assert filter_urls(spark.createDataFrame([(1, "http://a.com/en/")], schema), rules.where("false")).first().verdict == "allow"


def test_url_filter_keeps_long_ids(spark):
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    ids = [(1 << 60) + 1, -(1 << 62) - 1, (1 << 63) - 1, (1 << 53) + 1, None, 0, None]
    pages = spark.createDataFrame([(i, f"http://x{k}.com/{('en', 'de')[k % 2]}/") for k, i in enumerate(ids)], "page_id long, url string").coalesce(1)
    got = [(r.page_id, r.host, r.verdict) for r in filter_urls(pages, rules).collect()]
    assert sorted(got, key=str) == sorted(((i, f"x{k}.com", ("block", "allow")[k % 2]) for k, i in enumerate(ids)), key=str)


def _zip(force64, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        digest = hashlib.sha1(b"abc").hexdigest()
        packed = gzip.compress(warc.record(5, "http://x/%0A\n", b"abc", digest, None, False))
        with z.open(warc.WARC_MEMBER, "w", force_zip64=force64) as m:
            m.write(packed)
        z.writestr(warc.INDEX_MEMBER, '{"filename": "data.warc.gz", "offset": 0, "length": %d}' % len(packed))
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("force64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment"])
def test_zip_directories(force64, comment):
    data = _zip(force64, comment)
    read = lambda at, n: data[at : at + n]
    assert [m.name for m in warc.members(read, len(data))] == [warc.WARC_MEMBER, warc.INDEX_MEMBER]
    assert list(warc.records(read, len(data))) == [(5, "http://x/%0A\n", "response", None, 3, hashlib.sha1(b"abc").hexdigest(), b"abc")]


def test_zip64_end_record_is_used():
    data = _zip(False)
    end = data.rfind(b"PK\x05\x06")
    import struct

    count, length, offset = struct.unpack_from("<HII", data, end + 10)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, length, offset)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    broken = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = data[:end] + end64 + locator + broken
    assert len(warc.members(lambda at, n: data[at : at + n], len(data))) == 2


def test_zip_errors():
    packed = _zip(False, method=zipfile.ZIP_DEFLATED)
    read = lambda at, n: packed[at : at + n]
    with pytest.raises(ValueError, match="compressed"):
        list(warc.records(read, len(packed)))
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(lambda at, n: b"x" * n, 100)


def test_warc_round_trip(spark, tmp_path):
    long, html = "é" * 700, "<p>short</p>"
    rows = [(1, "http://a", long), (2, None, long), (3, "http://b\r\nx", html), (4, "http://c", html), (5, "http://d", None), (6, "http://e", ""), (None, "http://f", long), (2, "http://g", long), (7, "x" * 9000, "y" * 200_000)]
    pages = spark.createDataFrame([(*r, "digest") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}/w")).collect()
    want = []
    for i, url, text in rows:
        data = (text or "").encode()
        revisit = text == long and i != 2
        want.append((str(i), str(url), "revisit" if revisit else "response", str(2 if revisit else None), len(data), hashlib.sha1(data).hexdigest(), str(None if revisit else data)))
    assert sorted((str(r.page_id), str(r.url), r.record_type, str(r.refers_to), r.payload_bytes, r.payload_digest, str(None if r.payload is None else bytes(r.payload))) for r in got) == sorted(want)
    assert warc.read_archives(warc.write_archives(pages.where("false"), f"file://{tmp_path}/none")).count() == 0


def test_a_payload_on_most_rows_is_in_many_tasks(spark):
    hot, cold = "x" * 1_500, "y" * 1_500
    rows = [(i, f"http://a/{i}", hot if i % 3 == 0 else None if i % 3 == 1 else cold if i < 30 else f"{i}" * 400) for i in range(3_000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        got = warc.revisits(spark.createDataFrame(rows, "page_id long, url string, html string")).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {i: (2_997 if t == hot else 29 if t == cold else None) for i, _, t in rows}
    assert len(got) == len(rows) and {r.page_id: r.refers_to for r in got} == want
    assert {r.page_id for r in got if r.revisit} == {i for i, first in want.items() if first not in (None, i)}
    for payload in (hot, ""):
        tasks = [r.task for r in got if r.payload == payload]
        assert max(tasks.count(t) for t in set(tasks)) < 0.4 * len(tasks)

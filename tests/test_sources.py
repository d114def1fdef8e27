import json
import random

import pytest
from pyspark.sql import functions as F

from hazardloom.functions import dates, geo, text
from hazardloom.operators import aggregates, merge
from hazardloom.operators.places import resolve
from hazardloom.plans.delivery import Usage, deliver
from hazardloom.sources import files, gazetteer, pages
from hazardloom.streaming.change_only import emitted, emitted_stream, once_per_id


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_csv_last_file_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_id,mag,extra\n1,3.5,x\n2,,y\n")
    (tmp_path / "b.csv").write_text("event_id,mag,extra\n1,3.9,z\n1,4.0,z\n3,bad,z\n")
    rows = files.typed(files.csv_rows(spark, str(tmp_path), ("event_id", "mag", "depth_km")), ("mag",))
    got = {r.event_id: (r.mag, r.depth_km) for r in files.last_per_key(rows, ["event_id"]).collect()}
    assert got == {"1": (4.0, None), "2": (None, None), "3": (None, None)}


def test_json_lines_and_states(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"sha": "a", "text": "t"}\n\nnot json\n{"sha": "b"}\n')
    assert sorted(r.sha for r in files.json_lines(spark, str(tmp_path / "x.jsonl"), "sha string, text string").collect()) == ["a", "b"]
    state = tmp_path / "state"
    state.mkdir()
    (state / "quakes.json").write_text(json.dumps({"last_fetch": "2026-01-01T00:00:00+00:00", "last_status": 200}, indent=1))
    (state / "other.json").write_text('{"rows": 3}')
    (state / "broken.json").write_text("{")
    assert [(r.source, r.last_status) for r in files.poll_states(spark, str(state)).collect()] == [("quakes", 200)]


def test_months_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "m")
    table = lambda rows: spark.createDataFrame(rows, "k int, at string")
    files.write_months(table([(1, "2024-01-05"), (2, "2024-02-01")]), path, "at")
    files.write_months(table([(3, "2024-02-09")]), path, "at")
    assert sorted((r.k, str(r.month)) for r in spark.read.parquet(path).select("k", "month").collect()) == [(1, "2024-01"), (3, "2024-02")]


def test_quake_page(spark):
    row = '<tr><td><a href=".\\2026\\q.html">{at}</a></td><td>9.5</td><td>126.1</td><td>010</td><td>{mag}</td><td>012 km N 33&deg; E of&nbsp;Town (Province)</td></tr>'
    page = "<table>" + row.format(at="21 September 2026 - 08:58 AM", mag="4.1") + row.format(at="no time", mag="1") + "<tr><td>x</td></tr>" + row.format(at="21 September 2026 - 08:58 AM", mag="4.2").replace(".html", "_2.html") + "</table>"
    got = pages.quake_rows(spark.createDataFrame([(page,)], "html string"), "html").collect()
    assert [(r.event_id, r.mag, r.bulletin, r.depth_km) for r in got] == [("20260921T0858_9.5_126.1", 4.2, "2026/q_2.html", 10.0)]
    assert got[0].location == "012 km N 33° E of Town (Province)"
    unplaced = spark.createDataFrame([(1, page.replace("<td>9.5</td>", "<td>-</td>")), (0, page.replace("4.2", "9.9").replace("<td>9.5</td>", "<td></td>"))], "at int, html string")
    assert [(r.event_id, r.mag) for r in pages.quake_rows(unplaced, "html", "at").collect()] == [("20260921T0858__126.1", 4.2)]


def test_cells_by_id_and_days(spark):
    page = "".join(f'<td data-id="{d}">{v}</td>' for d, v in [("A", "Dec-31"), ("B", "Jan-01"), ("A", "95.2"), ("B", "&nbsp;80 "), ("A", "x")])
    got = pages.cells_by_id(spark.createDataFrame([(page,)], "html string"), "html", ["day", "level", "note"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("A", "Dec-31", "95.2", "x"), ("B", "Jan-01", "80", None)]
    day = lambda label: str(one(spark, pages.observation_day(F.lit(label), F.lit("2027-01-01").cast("date"))))
    assert [day("Dec-31"), day("Jan-02"), day("bad")] == ["2026-12-31", "2027-01-02", "None"]


def test_json_and_span_sources(spark):
    body = json.dumps([{"obscd": "1", "obsnm": "N", "wl": "12.35(*)", "alertwl": "13"}, {"obscd": "2", "wl": "---"}])
    assert [(s.code, s.level, s.flag, s.alert) for s in one(spark, pages.stations(F.lit(body)))] == [("1", 12.35, "*", 13.0)]
    assert [tuple(x) for x in one(spark, pages.named_levels(F.lit("<span>Mayon - 2</span><span class=a> Kanlaon  -  1 </span><span>none</span>")))] == [("Mayon", 2), ("Kanlaon", 1)]


def test_element_by_id_and_embedded_json(spark):
    page = '<div id="a"><div>x<br>&amp;<img src="q"/></div><b>y</b></div><p id=b>z</p><script>let regional = {"k": "}{", "n": [1]};</script>'
    assert one(spark, pages.inner_html(F.lit(page), "a")) == '<div>x<br>&amp;<img src="q"/></div><b>y</b>'
    assert one(spark, pages.inner_html(F.lit(page), "b")) == "z" and one(spark, pages.inner_html(F.lit(page), "c")) is None
    assert json.loads(one(spark, pages.embedded_json(F.lit(page), "regional"))) == {"k": "}{", "n": [1]}
    assert one(spark, pages.embedded_json(F.lit("let regional = {"), "regional")) is None


@pytest.mark.parametrize(("name", "key"), [("City of San José", "sanjose"), ("Sto. Niño (Faire)", "santonino"), ("Gen. Santos City", "generalsantos"), ("Mt. Apo", "mountapo"), ("", "")])
def test_name_keys(spark, name, key):
    assert one(spark, text.name_key(F.lit(name))) == key


def test_text_functions(spark):
    assert one(spark, text.block_text(F.lit("a<br><br/><br>b&amp;c<p> d </p>"))) == "a\n\nb&c d"
    # An entity ends with a semicolon, whatever else the text holds; a name that is none stays.
    for read in (text.cell_text, text.block_text):
        assert one(spark, read(F.lit("&copy; and&amp<p>&am &ampere; &eacute; &#233; &#xE9; &eacute &nosuch; &amp;copy;"))) == "© and&amp &am &ampere; é é é &eacute &nosuch; &copy;"
    assert one(spark, text.distinct_runs(F.array(*map(F.lit, "aabba")))) == ["a", "b", "a"]
    assert one(spark, text.number(F.lit(" -3.50 "))) == -3.5 and one(spark, text.number(F.lit("3 m"))) is None
    assert [one(spark, text.sql_literal(F.lit(v), n)) for v, n in (("", True), ("1.5", True), ("1.5", False), ("O'x", True))] == ["NULL", "1.5", "'1.5'", "'O''x'"]
    assert one(spark, text.scrub(F.lit("key=longsecret short"), ["longsecret", "short"])) == "key=*** short"


def test_dates(spark):
    loose = lambda s: str(one(spark, dates.stamp(dates.loose_date(F.lit(s)))))
    assert [loose(s) for s in ("5:00 AM, 26 September 2026", "26 Sept 2026 12:30 AM", "31 February 2026 1:00 PM")] == ["2026-09-26 05:00:00", "2026-09-26 00:30:00", "None"]
    assert [one(spark, dates.valid_hours(F.lit(s))) for s in ("within 2 to 3 hours", "in an hour", "later")] == [3, 1, 3]
    assert one(spark, dates.add_month(F.lit("2024-01"), -2)) == "2023-11"


def test_range_join_equals_all_pairs(spark):
    import random

    rng = random.Random(1)
    places = spark.createDataFrame([(i, rng.uniform(5, 21), rng.uniform(117, 126)) for i in range(60)] + [(99, None, 1.0)], "place long, lat double, lon double")
    events = spark.createDataFrame([(i, rng.uniform(5, 21), rng.uniform(117, 126)) for i in range(1500)], "event long, lat double, lon double")
    far = events.withColumnsRenamed({"lat": "a", "lon": "b"})
    want = places.join(far, geo.planar2(F.col("lat"), F.col("lon"), F.col("a"), F.col("b")) <= 2500).select("place", "event")
    got = geo.within(places, events, 50).select("place", "event")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 20


def test_band_and_day_sums_equal_counts(spark):
    from hazardloom.sources.tables import quakes

    q = quakes(spark, "/root/testdata/sf0.001")
    n = q.count()
    bands = aggregates.bands_to_newest(q, "town", "mag", "occurred_at", (3, 4, 5), 7)
    assert bands.select(F.sum(F.col("below") + F.col("band_low") + F.col("band_mid") + F.col("above"))).first()[0] == n
    assert aggregates.dense_daily(q, "occurred_at").agg(F.sum("n")).first()[0] == n


def test_second_run_changes_nothing(spark):
    rows = spark.createDataFrame([(i, f"v{i % 3}") for i in range(50)], "k long, v string")
    assert merge.rowhash_diff(rows, rows, ["k"]).count() == 0
    assert {r.change for r in merge.upsert(rows, rows, ["k"]).collect()} == {"same"}
    guarded = merge.replace_guarded(rows, rows.where("k < 20"), "v").collect()
    assert not any(r.replaced for r in guarded)


def test_places_in_order(spark, tmp_path):
    places = [("p1", "San Jose", "City", "10", "1", 14.0, 121.0), ("p2", "San Jose", "City", "20", "1", 14.5, 121.0), ("p3", "Lipa City", "City", "10", "1", 13.9, 121.1), ("p4", "Oton", "SubMun", "30", "2", 10.0, 122.0)]
    (tmp_path / "g.json").write_text(json.dumps([{"psgc_code": c, "name": n, "geographic_level": v, "province_code": p, "region_code": r, "coordinate": {"latitude": a, "longitude": o}} for c, n, v, p, r, a, o in places]))
    g = gazetteer.read(spark, str(tmp_path / "g.json"))
    asked = [(1, "San José", "20", None, None, None, None), (2, "Lippa", "10", None, None, None, None), (3, "City of Lipa", None, None, None, None, None), (4, "San Jose", None, None, None, None, None), (5, "San Jose", "99", None, "1", 14.1, 121.0), (6, "Old Lipa", "10", None, None, None, None), (7, "Oton", None, "2", None, None, None), (8, "Nowhere", None, None, None, None, None), (9, "San Jose", None, "1", None, None, None), (10, "Oton", "20", None, "1", 14.5, 121.0), (11, "Lippaa", "20", None, "1", 14.0, 121.0)]
    mentions = spark.createDataFrame(asked, "mention long, name string, province string, region string, home_region string, lat double, lon double")
    aliases = spark.createDataFrame([("10", "Old Lipa", "p3")], "province string, written_as string, code string")
    got = {r.mention: (r.code, r.how) for r in resolve(mentions, g, aliases).collect()}
    assert got == {1: ("p2", "province"), 2: ("p3", "alike"), 3: ("p3", "only"), 4: (None, None), 5: ("p1", "near"), 6: ("p3", "alias"), 7: ("p4", "region"), 8: (None, None), 9: ("p1", "region"), 10: (None, None), 11: (None, None)}


def test_alike_names_lose_none_to_the_index(spark):
    import difflib
    import random

    from hazardloom.operators.places import RATIO, alike

    rng = random.Random(6)
    stems = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    town_rows = [(p, k, f"{p}-{k}") for p in ("x", "y") for k in rng.sample(stems, 30)]
    def bent(k):
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(k) + 1)
            k = rng.choice([k[:at] + rng.choice("abcde") + k[at:], k[:at] + k[at + 1 :], k[:at] + rng.choice("abcde") + k[at + 1 :]])
        return k

    names = sorted({(p, bent(k)) for p in ("x", "y") for k in stems for _ in range(8)})
    got = {(r.province, r.key): r.alike for r in alike(spark.createDataFrame(names, "province string, key string"), spark.createDataFrame(town_rows, "province string, key string, code string")).collect()}
    for province, name in names:
        close = [c for p, k, c in town_rows if p == province and difflib.SequenceMatcher(None, k, name).ratio() >= RATIO and len(name) > 1]
        assert got.get((province, name)) == (close[0] if len(close) == 1 else None), (province, name, close)


def test_names_that_places_go_by(spark, tmp_path):
    from hazardloom.operators.places import outlook_places, province_keys

    rows = [("1", "Western Samar", "Prov", "1", "08"), ("2", "Davao de Oro", "Prov", "2", "11"), ("3", "Isabela", "Prov", "3", "02"), ("4", "City of Cebu (Independent City)", "Prov", "4", "07"), ("5", "Isabela City", "City", None, "09"), ("6", "Baganga", "Mun", "2", "11"), ("7", "Angeles", "City", None, "03"), ("8", "Isabela", "Mun", "9", "18")]
    (tmp_path / "g.json").write_text(json.dumps([{"psgc_code": c, "name": n, "geographic_level": v, "province_code": p, "region_code": r} for c, n, v, p, r in rows]))
    g = gazetteer.read(spark, str(tmp_path / "g.json"))
    keys = province_keys(g, gazetteer.province_aliases(spark))
    assert {r.key: r.code for r in keys.collect()} == {"westernsamar": "1", "samar": "1", "davaodeoro": "2", "compostelavalley": "2", "isabela": "3"}
    (tmp_path / "a.json").write_text(json.dumps([{"province": "Compostela Valley", "written_as": "Baculin", "is_in": "Baganga", "note": "x"}, {"province": "Isabela", "written_as": "y", "is_in": "Baganga"}, {"province": "Nowhere", "written_as": "y", "is_in": "Baganga"}]))
    assert [tuple(r) for r in gazetteer.town_aliases(spark, str(tmp_path / "a.json"), g, keys).collect()] == [("2", "Baculin", "6")]
    names = [("Metro Manila",), ("Isabela City, Zamboanga Peninsula",), ("Isabela City",), ("Isabela",), ("Samar, Eastern Visayas",), ("Angeles",), ("City of Nowhere",), ("Elsewhere",), ("NCR",)]
    regions = spark.createDataFrame(sorted({**gazetteer.REGIONS, "zamboangapeninsula": "09"}.items()), "key string, code string")
    got = {r.name: r.code for r in outlook_places(spark.createDataFrame(names, "name string"), g, keys, regions, gazetteer.CAPITAL).collect()}
    assert got == {"Metro Manila": "1300000000", "NCR": "1300000000", "Isabela City, Zamboanga Peninsula": "5", "Isabela City": None, "Isabela": "3", "Samar, Eastern Visayas": "1", "Angeles": "7", "City of Nowhere": None, "Elsewhere": None}


def _units(spark):
    return spark.createDataFrame([("status", 0, 1, False), ("2024-01", 2, 100, True), ("2024-03", 2, 100, True), ("2024-02", 2, 100, True), ("fresh", 1, 10, False)], "unit string, stage int, rows long, backlog boolean")


def test_delivery_order_budget_and_resume(spark):
    sent, stored = [], []
    usage = Usage("d", cost_per_row=5)
    out = deliver(_units(spark), lambda u: sent.append(u) or 500, usage, stored.append, budget=10_000, reserve=0)
    assert out.state == "done" and sent == stored == ["status", "fresh", "2024-03", "2024-02", "2024-01"] and usage.written == 2500
    out = deliver(_units(spark), lambda u: 500, Usage("d", cost_per_row=5), stored.append, budget=2000, reserve=600)
    assert out.state == "budget" and out.delivered == ["status"]
    assert Usage("d", 900, cost_per_row=6.0).on("e") == Usage("e", cost_per_row=6.0)

    def fails(unit):
        if unit == "2024-03":
            raise OSError("gone")
        return 10

    stored.clear()
    out = deliver(_units(spark), fails, Usage("d"), stored.append)
    assert (out.state, out.error, stored) == ("failed", "gone", ["status", "fresh"])


def test_stream_emits_what_the_fold_emits(spark, tmp_path):
    import random

    rng = random.Random(4)
    rows = [(i % 3, 1000 + 600 * i, i, rng.choice(["low", "low", "high"])) for i in range(90)]
    schema = "town long, at long, seq long, level string"
    want = sorted(tuple(r) for r in emitted(spark.createDataFrame(rows, schema), "town", "at", "level", "seq", 7200).collect())
    source, out = str(tmp_path / "in"), []
    for part in range(3):
        spark.createDataFrame(rows[part * 30 : part * 30 + 30], schema).coalesce(1).write.mode("append").parquet(source)
        stream = emitted_stream(spark.readStream.schema(schema).parquet(source), "town", "at", "level", "seq", 7200)
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, _: out.extend(tuple(r) for r in df.collect())).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert sorted(out) == want and len(want) < len(rows)


def test_once_per_id_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), []
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:01:00"), (2, "2024-01-01 00:02:00")], "id long, at string").withColumn("at", F.to_timestamp("at"))
    rows.coalesce(1).write.parquet(source)
    stream = once_per_id(spark.readStream.schema(rows.schema).parquet(source), "id", "at", "1 hour")
    stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, _: out.extend(r.id for r in df.collect())).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(out) == [1, 2]


def test_dam_days_and_basins(spark):
    today = ["", "8:00 AM", "95.2", "-", "0.1", "100", "-4.8", "90", "5.2", "2", "1.5", "30", "40", "Jan-01"]
    before = ["8:00 AM", "95.1", "-4.9", "90", "5.1", "1", "0.5", "20", "10", "Dec-31"]
    cells = lambda dam, values: "".join(f'<td data-id="{dam}" class="c">{v}</td>' for v in values)
    page = cells("A", today + before) + cells("B", today[:13]) + cells("C", today) + cells("D", [*today[:2], "", *today[3:]])
    page += '<tr> <td>Upper Sub-basin</td><td class="s"> <a href="#">Non&amp;flood</a></td></tr><tr><td>Other</td><td><a>x</a></td></tr>'
    rows = spark.createDataFrame([(7, page)], "page long, html string")
    got = pages.dam_days(rows, "html", F.lit("2027-01-01").cast("date")).collect()
    seen = {(r.page, r.dam, str(r.obs_date), r.obs_time, r.rwl_m, r.dev_24h_m, r.nhwl_m, r.gates, r.outflow_cms) for r in got}
    assert seen == {(7, "A", "2027-01-01", "8:00 AM", "95.2", "0.1", "100", "2", "40"), (7, "A", "2026-12-31", "8:00 AM", "95.1", "", "100", "1", "10"), (7, "C", "2027-01-01", "8:00 AM", "95.2", "0.1", "100", "2", "40")}
    assert [tuple(x) for x in one(spark, pages.basin_status(F.lit(page)))] == [("Upper Sub-basin", "Non&flood")]


def test_advisories(spark):
    first = "Thunderstorm Advisory No. 12A<br>Issued at: 5:00 AM, 26 September 2026<br>Heavy rain is expected over Town within 2 hours."
    none = "There is no Rainfall Warning issued for this region as of now, see the archive."
    page = f'<div id="rainfalls"><div>{none}</div><div>short</div></div><div id="thunderstorms"><div>{first}</div> <div class="x">Advisory without a number or a time, but long enough to count.</div></div>'
    rows = spark.createDataFrame([(page, "ncr"), ("<div id=rainfalls></div>", "sl"), (None, "x")], "html string, region string")
    got = sorted((r.region, r.kind, r.title, r.number, str(r.issued_at), r.id.rpartition(":")[0]) for r in pages.advisories(rows, "html", "region").collect())
    assert got == [
        ("ncr", "thunderstorm", "Advisory without a number or a time, but long enough to count.", "", "None", "ncr:thunderstorm:na:na"),
        ("ncr", "thunderstorm", "Thunderstorm Advisory No. 12A", "12A", "2026-09-26 05:00:00", "ncr:thunderstorm:2026-09-26T05:00:00+08:00:12A"),
    ]
    assert [r[0] for r in rows.select(pages.has_layout(F.col("html"))).collect()] == [True, False, False]


def test_bulletin_pages(spark):
    body = lambda name: f"<h3>Typhoon {name}</h3><br>TOS<br><br>Typhoon {name}<br>" + "Winds of the storm blow. " * 12 + "<!-- old --><br>Tropical Cyclone Bulletin Archive<br>list"
    page = f'<p>menu</p><div class="col article-content"><div class="tab-pane fade">{body("A")}</div><div class="tab-pane">No Active Tropical Cyclone</div><div class="tab-pane">{body("B")}</div>We always find ways to improve {body("C")}'
    whole = page.replace("tab-pane", "other")
    rows = spark.createDataFrame([(1, page), (2, "<p>short</p>"), (3, None), (4, whole.replace("No Active Tropical Cyclone", ""))], "page long, html string")
    got = sorted((r.page, r.text[:10], "Archive" in r.text or "menu" in r.text or "TOS" in r.text, r.text.count("Typhoon"), len(r.sha)) for r in pages.bulletin_rows(rows, "html").collect())
    assert got == [(1, "Typhoon A\n", False, 1, 16), (1, "Typhoon B\n", False, 1, 16), (4, "Typhoon A\n", False, 1, 16)]
    clean = lambda t: one(spark, text.bulletin_text(F.lit(t)))
    assert clean("a\n\n\na\nb\nx -->\nb\n\n\nc\nTOS\nTropical cyclone bulletin archive\nd") == "a\nb\n\nc"


def test_states_after_polls(spark):
    from datetime import datetime

    from hazardloom.operators import polling

    t = lambda h: datetime(2026, 1, 1, h)
    none = (None,) * 7
    states = spark.createDataFrame([("a", t(1), 200, "old", t(1), "e0", "m0", None), ("b", *none), ("same", t(2), 304, "n", t(1), "e", "m", t(3))], "source string, last_fetch timestamp, last_status int, last_note string, last_ok timestamp, etag string, last_modified string, cooldown_until timestamp")
    polls = [
        ("a", t(2), 200, "unreadable", False, False, "e1", "m1"), ("a", t(3), 304, "304", True, False, "e2", "m2"),  # neither moves the marks
        ("b", t(2), 200, "fine", True, False, "e3", None), ("b", t(4), 200, "wall", True, True, "e4", "m4"),
        ("new", t(5), 429, "slow", None, None, None, None), ("new", t(4), 403, "no", None, None, None, None),
    ]
    df = spark.createDataFrame(polls, "source string, at timestamp, status int, note string, ok boolean, challenge boolean, etag string, last_modified string")
    after = polling.states_after(states, df)
    got = {r.source: tuple(r)[1:] for r in after.collect()}
    assert got["a"] == (t(3), 304, "304", t(1), "e0", "m0", None)
    assert got["b"] == (t(2), 200, "fine", t(2), "e3", None, datetime(2026, 1, 2, 4))
    assert got["new"] == (None, None, None, None, None, None, t(11)) and got["same"] == (t(2), 304, "n", t(1), "e", "m", t(3))
    may = {r.source: (r.cooling, r.due) for r in polling.may_poll(after, F.lit(t(4)), F.lit(60)).collect()}
    assert may == {"a": (False, True), "b": (True, True), "new": (True, True), "same": (False, True)}


def test_exposure_runs_to_today(spark):
    places = spark.createDataFrame([(1, 14.0, 121.0)], "town_id long, lat double, lon double")
    events = spark.sql("select 14.0D as lat, 121.0D as lon, 4.5D as mag, timestamp_ntz'2024-07-01 00:00:00' as occurred_at")
    years = lambda today: aggregates.radius_rates(places, events, "town_id", "2024-01-01", today=today).first().years
    assert years(None) == 0.5 and years(F.lit("2024-02-01").cast("date")) == 0.5 and years(F.lit("2026-01-01").cast("date")) == round(731 / 365.25, 6)


def test_basin_names_with_any_entity(spark):
    page = "<tr><td>Las Pi&ntilde;as Sub-basin</td><td><a href='#'>Alert &mdash; x</a></td></tr><tr><td>other</td></tr>"
    assert one(spark, pages.basin_status(F.lit(page))) == [("Las Piñas Sub-basin", "Alert — x")] and one(spark, pages.basin_status(F.lit("none"))) == []


def test_nearest_places_match_brute_force(spark):
    from hazardloom.functions.geo import FAR, haversine, nearest

    rng = random.Random(4)
    spot = lambda: rng.choice([(rng.uniform(-90, 90), rng.uniform(-180, 180)), (10 + rng.random() / 50, 120 + rng.random() / 50), (10.0, 179.999 * rng.choice([-1, 1])), (89.9, rng.uniform(-180, 180)), (None, 5.0)])
    places = spark.createDataFrame([(k, *spot(), c) for c in range(300) for k in ("a", "b")] + [("c", None, None, 7), ("a", 10.0, 120.0, 900), ("a", 10.0, 120.0, 800)], "key string, lat double, lon double, code long")
    points = spark.createDataFrame([(rng.choice("abcd"), *spot()) for _ in range(200)] + [("a", 10.0, 120.0)] * 3, "key string, lat double, lon double")
    pairs = points.distinct().join(places.withColumnsRenamed({"lat": "p_lat", "lon": "p_lon"}), "key").withColumn("km", haversine(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")))
    for km in (None, 120.0):
        got = {(r.key, r.lat, r.lon): tuple(r.near) for r in nearest(points, places, ["key"], km).collect()}
        near = pairs.where(F.col("km") < (km or 2 * FAR)).groupBy("key", "lat", "lon").agg(F.min(F.struct("km", "code")).alias("near"))
        assert got == {(r.key, r.lat, r.lon): tuple(r.near) for r in near.collect()}


def test_mentions_do_not_meet_every_town_of_their_name(spark):
    n = 60_000  # squared, far more pairs than a test can make
    towns = spark.range(n).selectExpr("id as code", "'x' as key", "'City' as level", "id % 5 as province", "id % 5 as region", "id / 6000.0D as lat", "120.0D as lon")
    homes = spark.range(5, 8).selectExpr("-id as code", "concat('p', id) as key", "'Prov' as level", "id as province", "id - 5 as region", "10.0D as lat", "120.0D as lon").withColumn("code", F.col("province"))
    asks = spark.range(n).selectExpr("id as mention", "'x' as name", "if(id % 2 = 0, id % 8, null) as province", "if(id % 2 = 1, id % 5, null) as region")
    found = resolve(asks, towns.unionByName(homes), fuzzy=False).groupBy("how").agg(F.count("code").alias("n"), F.min("code").alias("least"), F.max("code").alias("most")).collect()
    # A province of its own has the town; province 6 lies in region 1, whose last town is the nearest; of a region the first town counts.
    assert {r.how: (r.n, r.least, r.most) for r in found} == {"province": (n // 8 * 3, 0, 4), "near": (n // 8, 59996, 59996), "region": (n // 2, 0, 4)}


def test_expanded_towns_are_not_gathered_again(spark):
    from hazardloom.operators.places import STATUSES, advisory_towns

    rng = random.Random(6)
    g = [(c, "SubMun" if c % 4 == 0 else "City", c % 5, c % 5 % 2) for c in range(40)]
    said = [(i, kind, rng.randrange(n) if kind != "town" else None, rng.randrange(42) if kind == "town" else None, rng.choice(STATUSES)) for i in range(60) for kind, n in (("province", 6), ("region", 3), ("town", 0)) for _ in range(rng.randrange(4))]
    best = {}
    for i, kind, place, code, status in said:
        for c in [code] if kind == "town" else [c for c, level, p, r in g if (place == p if kind == "province" else place == r and level != "SubMun")]:
            best[i, c] = max(best.get((i, c), 0), STATUSES.index(status))
    areas = spark.createDataFrame(said + [(99, "town", None, None, "watch")], "k long, kind string, place long, code long, status string")
    found = advisory_towns(areas, "k", spark.createDataFrame(g, "code long, level string, province long, region long"))
    assert sorted(map(tuple, found.collect())) == sorted((i, c, STATUSES[s]) for (i, c), s in best.items())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")  # nothing is aggregated or shuffled behind the joins that expand

"""What is shuffled when rows repeat the same names and areas."""

import json
import random
import time
from collections import Counter

from pyspark.sql import functions as F

from hazardloom.operators import places as P

GAZETTEER = "code long, name string, level string, province long, region long, lat double, lon double, key string"


def _gazetteer(spark, towns):
    rows = [(k, f"Town {k}", "City", 1, 1, 10.0 + k % 7, 120.0, f"town{k}") for k in range(100, 100 + towns)]
    return spark.createDataFrame([(1, "Cebu", "Prov", 1, 1, 10.0, 120.0, "cebu"), *rows], GAZETTEER)


def _shuffled(spark, df):
    """Bytes that a run of ``df`` writes to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        before = -1
        while before != (now := store.executorList(False).apply(0).totalShuffleWrite()):
            before = now
            time.sleep(0.5)
        return now

    start = written()
    df.write.format("noop").mode("overwrite").save()
    return written() - start


def test_summaries_do_not_shuffle_the_towns_of_whole_provinces(spark):
    g = _gazetteer(spark, 2_000)
    areas = "k long, sentence int, entry int, status string, likelihood string, kind string, place long, town string, code long"
    n = 400
    rows = [(k, 0, 0, "expected", None, "province", 1, None, None) for k in range(n)] + [(k, 0, 1, "occurring", None, "town", 1, "x", 100 + k % 9) for k in range(n)]
    said, all_of = spark.createDataFrame(rows, areas), spark.range(n + 1).withColumnRenamed("id", "k")
    out = P.advisory_summary(all_of, said, "k", g)
    got = {r.k: r for r in out.where("k in (3, 400)").collect()}
    assert got[3].n_towns == 2_000 and got[3].status == "occurring" and got[3].provinces == {1: 2_000}
    assert [t.status for t in got[3].towns[:5]] == ["expected"] * 3 + ["occurring", "expected"] and [t.code for t in got[3].towns[:2]] == [100, 101]
    assert got[400].n_towns == 0 and got[400].towns_json == "[]" and got[400].provinces_json == "{}" and got[400].status is None
    assert _shuffled(spark, out) < 2_000_000  # 800,000 towns of advisories take more


def test_a_name_is_asked_for_once(spark):
    g = _gazetteer(spark, 50)
    n = 20_000
    mentions = spark.range(n).select(F.col("id").alias("mention"), F.concat(F.lit("Town "), (100 + F.col("id") % 30).cast("string")).alias("name"), F.when(F.col("id") % 2 == 0, F.lit(1)).cast("long").alias("province"), F.lit(None).cast("long").alias("region"))
    assert P.resolve_names(mentions, g, fuzzy=False).count() == 30
    out = P.resolve(mentions, g, fuzzy=False)
    assert {(r.name, r.how, r.code) for r in mentions.join(out, "mention").distinct().collect()} == {(f"Town {100 + k}", "only" if k % 2 else "province", 100 + k) for k in range(30)}
    assert _shuffled(spark, out) < 1_000_000  # once each mention's row, not once a rule


def test_events_of_one_place_share_its_answer(spark):
    g = _gazetteer(spark, 50)
    events = spark.range(20_000).select("id", F.concat(F.lit("010 km N 33 E of Town "), (100 + F.col("id") % 30).cast("string"), F.lit(" (Cebu)")).alias("location"))
    out = P.event_towns(events, "id", "location", g, fuzzy=False)
    assert out.where("province_code = 1 and city_code = 100 + id % 30 and km = 10").count() == 20_000
    nothing = P.event_towns(spark.createDataFrame([(1, None), (2, "Open sea"), (3, "")], "id long, location string"), "id", "location", g, fuzzy=False).collect()
    assert sorted((r.id, r.raw_town, r.province_code, r.city_code) for r in nothing) == [(1, None, None, None), (2, "Open sea", None, None), (3, None, None, None)]
    assert _shuffled(spark, out) < 1_500_000


def test_keys_are_not_made_anew_for_each_of_their_letters(spark):
    from hazardloom.sources.gazetteer import of_tables

    towns = of_tables(spark, "/root/testdata/sf0.001").where("level != 'Prov'").select("province", "key", "code")
    found = P.alike(spark.createDataFrame([(1, "townn7"), (1, "x"), (1, "")], "province int, key string"), towns)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_replace" in line and "sequence" in line]


def test_locations_are_read_in_many_tasks(spark):
    from hazardloom.registry import QUERIES

    plan = QUERIES["quake_towns"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [event_id" in plan


def test_texts_of_advisories_are_read_once(spark):
    g, read = _gazetteer(spark, 20), spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([(k, f"Rain is expected over Cebu (Town {100 + k}). \nFlooding is affecting Cebu.") for k in range(8)], 2)
    texts = spark.createDataFrame(rows.map(lambda r: (read.add(1), r)[1]), "k long, text string")
    areas = P.advisory_areas(texts, "k", "text", g, P.province_keys(g), spark.createDataFrame([], "key string, code long"), fuzzy=False)
    assert P.advisory_towns(areas, "k", g).count() == 8 * 20
    assert read.value == 8


def test_towns_that_are_named_stand_among_those_of_whole_areas(spark):
    rng = random.Random(5)
    towns = [(c, f"T{c}", "SubMun" if c % 4 == 0 else "City", c % 5, c % 5 % 2, c / 8 if c % 7 else None, 120.0, f"t{c}") for c in rng.sample(range(1000), 60)]
    codes = [t[0] for t in towns]
    said = [(i, kind, rng.randrange(n) if kind != "town" else None, rng.choice([*codes, 2000]) if kind == "town" else None, rng.choice(P.STATUSES)) for i in range(50) for kind, n in (("province", 6), ("region", 3), ("town", 0)) for _ in range(rng.randrange(4))]
    best = {}
    for i, kind, place, code, status in said:
        for c in [code] if kind == "town" else [t[0] for t in towns if (place == t[3] if kind == "province" else place == t[4] and t[2] != "SubMun")]:
            best.setdefault(i, {})[c] = max(best.get(i, {}).get(c, 0), P.STATUSES.index(status))
    place = {t[0]: t for t in towns}
    areas = spark.createDataFrame(said, "k long, kind string, place long, code long, status string")
    out = P.advisory_summary(spark.range(51).withColumnRenamed("id", "k"), areas, "k", spark.createDataFrame(towns, GAZETTEER), {"first_code": F.col("first")["code"], "first_status": F.col("first")["status"]})
    for r in out.collect():
        want = sorted(best.get(r.k, {}).items())
        found = [[round(place[c][5], 3) if c in place and place[c][5] is not None else None, 120.0 if c in place else None, str(c), P.STATUSES[s][0]] for c, s in want]
        assert json.loads(r.towns_json) == found and r.n_towns == len(want) and r.status == (P.STATUSES[max(s for _, s in want)] if want else None)
        assert [(t.code, t.status) for t in r.towns] == [(c, P.STATUSES[s]) for c, s in want]
        assert (r.first_code, r.first_status) == ((want[0][0], P.STATUSES[want[0][1]]) if want else (None, None))
        assert r.provinces == dict(Counter(place[c][3] for c, _ in want if c in place)) and json.loads(r.provinces_json) == {str(p): n for p, n in r.provinces.items()}

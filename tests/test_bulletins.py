from pyspark.sql import functions as F

from hazardloom.functions import areas, bulletins
from hazardloom.functions.text import name_key

TEXT = """Typhoon "Queenie"

Issued at 11:00 am, 27 September 2026

(Valid for broadcast until the next advisory to be issued at 5:00 AM tomorrow)

QUEENIE FURTHER INTENSIFIES AND IS ABOUT TO EXIT THE AREA OF RESPONSIBILITY.

HAZARDS AFFECTING LAND AREAS
QUEENIE is unlikely to affect the country with winds of 90 km/h.
HAZARDS AFFECTING COASTAL WATERS
Up to 2.0 m: the northern seaboard.
TRACK AND INTENSITY OUTLOOK
QUEENIE will move northeastward.

Location of Eye/center

The center of the eye of Typhoon QUEENIE was estimated at 700 km East (24.9 °N, 132. °E )

Movement

Moving North Northeastward at 10 km/h

Strength

Maximum sustained winds of 150 km/h near the center and gustiness of up to 185 km/h

Forecast Position

Sep 27, 2026 08:00 PM - 925 km Northeast of Luzon (OUTSIDE PAR)

Sep 28, 2026 08:00 AM – 300 km East of Luzon

Wind Signal

TCWS No. 2
Luzon
The northern portion of mainland Cagayan (Santa Ana, Aparri, and Buguey) and Babuyan Islands
Wind threat: Gale-force winds
TCWS No. 1
Visayas
Samar, The rest of Cagayan
Warning lead time: 36 hours

Considering these developments, the public is advised to act.
"""


def test_fields(spark):
    old = TEXT.replace('Typhoon "Queenie"', "").replace("5:00 AM tomorrow", "5:30 P.M., 2 October 2026").replace("11:00 am,", "11:00 p.m.")
    rows = spark.createDataFrame([(1, TEXT), (2, 'Typhoon "X"\n\nsomething else'), (3, None), (4, TEXT.replace("27 September", "31 September")), (5, old)], "id int, text string")
    got = {r.id: r for r in bulletins.fields(rows, "text").collect()}
    a = got[1]
    assert (a.category, a.name, str(a.issued_at), str(a.next_at)) == ("Typhoon", "Queenie", "2026-09-27 11:00:00", "2026-09-28 05:00:00")
    assert a.headline == "QUEENIE FURTHER INTENSIFIES AND IS ABOUT TO EXIT THE AREA OF RESPONSIBILITY." and a.status == "exiting"
    assert (a.lat, a.lon, a.wind_kmh, a.gust_kmh, a.movement, a.reason) == (24.9, 132.0, 150, 185, "Moving North Northeastward at 10 km/h", None)
    assert (a.land[:7], a.coast, a.outlook) == ("QUEENIE", "Up to 2.0 m: the northern seaboard.", "QUEENIE will move northeastward.")
    assert [(str(f["at"]), f["text"], f["outside"]) for f in a.forecasts] == [("2026-09-27 20:00:00", "925 km Northeast of Luzon (OUTSIDE PAR)", True), ("2026-09-28 08:00:00", "300 km East of Luzon", False)]
    assert a.signals.startswith("TCWS No. 2") and a.signals.endswith("36 hours")
    b = got[2]
    assert (b.name, b.category, b.issued_at, b.headline, b.status, b.reason) == ("X", "Typhoon", None, None, "unknown", "no issue time")
    assert (b.forecasts, b.movement, b.land) == ([], None, None)
    assert got[3].reason == "no name, no issue time" and got[4].issued_at is None
    assert (got[5].name, got[5].category, str(got[5].issued_at), str(got[5].next_at)) == (None, "Typhoon", "2026-09-27 23:00:00", "2026-10-02 17:30:00")


def test_headlines(spark):
    valid = "(Valid for broadcast until then)\n"
    cases = [(valid + "\n  X HAS EXITED THE AREA.\nNEXT LINE", "X HAS EXITED THE AREA."), (valid + "SHORT ONE\nLONGER THAN THAT", None), (valid + "Not In Capitals At All", None), (valid + bulletins.LAND, None), ("X HAS EXITED THE AREA.\nmore", "X HAS EXITED THE AREA.")]
    rows = spark.createDataFrame(cases, "t string, want string").withColumn("got", bulletins.headline(F.col("t"))).collect()
    assert all(r.want == r.got for r in rows)


def test_status_rules(spark):
    cases = [
        ("X HAS ENTERED THE AREA", "at 500 km East", "", "inside"), ("X HAS EXITED", "(OUTSIDE PAR)", "", "outside"), ("X MOVES", "1,500 km ( outside the PAR)", "X is forecast to enter the PAR", "entering"),
        ("X IS ABOUT TO EXIT", "(OUTSIDE PAR)", None, "outside"), ("X IS LIKELY TO RE-ENTER", "(OUTSIDE PAR)", None, "entering"), ("X EXITING", "at sea", None, "exiting"), ("X IS LEAVING", None, None, "exiting"),
        ("X LEFT THE AREA", None, "about to reenter", "entering"), ("X STRENGTHENS", None, None, "unknown"), (None, None, None, "unknown"), (None, "at sea", None, "inside"),
    ]
    rows = spark.createDataFrame(cases, "h string, c string, o string, want string")
    assert all(r.want == r.got for r in rows.withColumn("got", bulletins.area_status(F.col("h"), F.col("c"), F.col("o"))).collect())


def test_signal_areas(spark):
    rows = spark.createDataFrame([(1, TEXT), (2, "No Wind Signal"), (3, None)], "id int, text string")
    got = {(r.id, r.signal, r.area, r.kind, r.province, r.within) for r in bulletins.signal_areas(rows, "id", "text").collect()}
    north = "The northern portion of mainland Cagayan"
    assert got == {
        (1, 2, north, "portion", "Cagayan", None), (1, 2, "Santa Ana", "city", "Cagayan", north), (1, 2, "Aparri", "city", "Cagayan", north), (1, 2, "Buguey", "city", "Cagayan", north),
        (1, 2, "Babuyan Islands", "place", "Babuyan Islands", None), (1, 1, "Samar", "place", "Samar", None), (1, 1, "The rest of Cagayan", "portion", "Cagayan", None),
    }


SIGNALS = """Wind Signal No. 3
Luzon: The northern and central portions of Quezon (Gen. Nakar, Burdeos and San Isidro), Metro Manila, Polillo
Islands
Wind threat: storm-force winds over Aurora
Signal #2
LUZON
Aurora and the rest of Quezon, Camarines Norte (San Isidro; Daet) Visayas
The extreme northern portion of Nowhere (Basud), Burdeos, San Isidro
Wind Signal Number 1
Somewhere (Aparri), Babuyan Islands (Calayan), Cagayan (Daet, Daet, Daet)
Beaufort 6
"""


def test_signals_with_codes(spark):
    places = [("Q", "Quezon", "Prov", "Q", "R4"), ("A", "Aurora", "Prov", "A", "R3"), ("C", "Camarines Norte", "Prov", "C", "R5"), ("G", "Cagayan", "Prov", "G", "R2"), ("X", "Somewhere (Independent City)", "Prov", "X", "R9")]
    towns = [("Q1", "General Nakar", "Mun", "Q", "R4"), ("Q2", "Burdeos", "Mun", "Q", "R4"), ("Q3", "San Isidro", "Mun", "Q", "R4"), ("C1", "San Isidro", "Mun", "C", "R5"), ("C2", "Daet", "Mun", "C", "R5"), ("C3", "Basud", "Mun", "C", "R5")]
    g = spark.createDataFrame(places + towns, "code string, name string, level string, province string, region string").withColumns({"key": name_key(F.col("name")), "lat": F.lit(14.0), "lon": F.lit(121.0)})
    regions = spark.createDataFrame([("Metro Manila", "R13")], "name string, code string")
    islands = spark.createDataFrame([("Polillo Islands", "Quezon"), ("Babuyan Islands", "Cagayan")], "name string, province string")
    rows = spark.createDataFrame([(1, SIGNALS), (2, "No Tropical Cyclone Wind Signal. Wind Signal No. 1 Aurora"), (3, None)], "id int, text string")
    got = {tuple(r) for r in bulletins.coded_signals(bulletins.signal_areas(rows, "id", "text"), "id", g, regions, islands).collect()}
    assert got == {
        (1, 3, "The northern and central portions of Quezon", "portion", "Q", None), (1, 3, "Gen. Nakar", "city", "Q", "Q1"), (1, 3, "Burdeos", "city", "Q", "Q2"), (1, 3, "San Isidro", "city", "Q", "Q3"),
        (1, 3, "Metro Manila", "province", "R13", None), (1, 3, "Polillo Islands", "portion", "Q", None),
        (1, 2, "Aurora", "province", "A", None), (1, 2, "the rest of Quezon", "portion", "Q", None), (1, 2, "Camarines Norte", "province", "C", None), (1, 2, "San Isidro", "city", "C", "C1"), (1, 2, "Daet", "city", "C", "C2"),
        (1, 2, "The extreme northern portion of Nowhere", "portion", None, None), (1, 2, "Basud", "city", "C", "C3"), (1, 2, "Burdeos", "city", "Q", "Q2"),
        (1, 1, "Somewhere (Aparri)", "portion", None, None), (1, 1, "Babuyan Islands", "portion", "G", None), (1, 1, "Cagayan", "province", "G", None), (1, 1, "Daet", "city", "G", None), (1, 1, "Daet, Cagayan", "city", "G", None),
    }


# A section as such bulletins write it, with 29 areas and towns.
SECTION = """TCWS No. 3
Luzon
The northern portion of mainland Cagayan (Santa Ana, Gonzaga, Aparri, and Buguey) and Babuyan Islands
Wind threat: Storm-force winds
Warning lead time: 18 hours
Range of wind speeds: 89 to 117 km/h (Beaufort 10 to 11)
Potential impacts: Moderate to significant

TCWS No. 2
Luzon
Batanes, the rest of Cagayan, the northern and central portions of Isabela (Palanan, Divilacan, Maconacon, San Pablo, and Ilagan City), Apayao, and Ilocos Norte
Wind threat: Gale-force winds

TCWS No. 1
Luzon
The rest of Isabela, the northern portion of Aurora (Dilasag, Casiguran, and Dinalungan), Kalinga, Abra, Metro Manila, and Polillo Islands
Visayas
Northern Samar and Eastern Samar
Mindanao
Dinagat Islands and Siargao Islands
Wind threat: Strong winds
Warning lead time: 36 hours
"""


def test_the_section_of_29_rows(spark):
    rows = spark.createDataFrame([(1, SECTION), (2, "No Tropical Cyclone  Wind Signal\nTCWS No. 1 Aurora"), (3, ""), (4, None), (5, "TCWS No. 10 Aurora"), (6, "TCWS 3 Aurora")], "id int, text string")
    got = bulletins.signal_areas(rows, "id", "text").collect()
    assert {r.id for r in got} == {1} and len(got) == 29
    assert [r.area for r in got if r.signal == 3 and r.kind == "city"] == ["Santa Ana", "Gonzaga", "Aparri", "Buguey"]
    assert {r.area: r.province for r in got if r.kind == "portion"} == {
        "The northern portion of mainland Cagayan": "Cagayan", "the rest of Cagayan": "Cagayan", "the northern and central portions of Isabela": "Isabela", "The rest of Isabela": "Isabela", "the northern portion of Aurora": "Aurora",
    }
    assert [r.area for r in got if r.kind == "place"] == ["Babuyan Islands", "Batanes", "Apayao", "Ilocos Norte", "Kalinga", "Abra", "Metro Manila", "Polillo Islands", "Northern Samar", "Eastern Samar", "Dinagat Islands", "Siargao Islands"]


def _areas(spark, text):
    rows = spark.createDataFrame([(text,)], "text string")
    found = areas.register(spark).sql("select s.* from {rows} t, lateral parse_areas(t.text) s", rows=rows).collect()
    return [(r.sentence, r.status, r.likelihood, r.name, r.whole, r.towns, r.unmatched) for r in found]


def test_advisory_areas(spark):
    assert _areas(spark, "Rain is expected over Bataan (Limay, Mariveles, and Orion), Metro Manila (Quezon City), and Zambales (Iba) within 2 hours.") == [
        (0, "expected", "", "Bataan", False, ["Limay", "Mariveles", "Orion"], None), (0, "expected", "", "Metro Manila", False, ["Quezon City"], None), (0, "expected", "", "Zambales", False, ["Iba"], None),
    ]
    assert _areas(spark, "Showers ARE  being experienced\nin A\n\nRain are being experienced in #Bohol(SierraBullones, Pilar) and the rest of Cebu which may persist") == [(0, "occurring", "", "Bohol", False, ["SierraBullones", "Pilar"], None), (0, "occurring", "", "Cebu", True, [], None)]
    assert _areas(spark, "Rain is expected over A (b) c, and portions of Gen. D. and is affecting E for the next hour") == [
        (0, "expected", "", None, False, [], "A (b) c"), (0, "expected", "", "Gen. D.", True, [], None), (0, "expected", "", "is affecting E", True, [], None), (1, "occurring", "", "E", True, [], None),
    ]
    assert _areas(spark, "Storms are less likely to develop over A.\nMore likely to develop over (x)") == [(0, "watch", "LESS", "A", True, [], None), (1, "watch", "MORE", None, False, [], "(x)")]
    assert _areas(spark, None) == [] and _areas(spark, "is expected over") == [] and _areas(spark, "are affecting within 2 hours") == [(0, "occurring", "", "within 2 hours", True, [], None)]


def test_split_areas(spark):
    rows = spark.createDataFrame([("A (x, y and z), B [c, d] and C; island and sea and the End.",), (None,)], "text string")
    got = areas.register(spark).sql("select s.* from {rows} t, lateral split_areas(t.text) s order by pos", rows=rows).collect()
    assert [(r.part, r.towns) for r in got] == [("A (x, y and z)", ["x", "y", "z"]), ("B [c, d]", []), ("C", []), ("island and sea", []), ("the End", [])]


def test_active_cyclones(spark):
    from datetime import datetime

    t = lambda d, h=0: datetime(2026, 9, d, h)
    rows = spark.createDataFrame([("X", t(1), t(1, 6)), ("X", t(2), t(2, 6)), ("Y", t(2), None), ("Z", t(1), t(1, 6)), ("W", t(3), t(4))], "name string, issued_at timestamp, next_at timestamp")
    states = lambda note: spark.createDataFrame([("tcb", note), ("other", "none issued")], "source string, last_note string")
    active = lambda note: sorted(r.name for r in bulletins.active_cyclones(rows, states(note), "tcb", "none issued", F.lit(t(2, 5))).collect())
    assert active("2 bulletins") == ["X", "Y"] and active("none issued today") == [] and active(None) == ["X", "Y"]

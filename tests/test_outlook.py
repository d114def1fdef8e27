import json

from hazardloom.sources import outlook

ITEM = '<div class="outlook-item"><span style="font-weight: bold">{day}</span><img src="x" title="Cloudy &amp; calm"><span class="low"> 24</span><span class="high">32</span><div><span>Wind Speed:</span><span>Light</span></div><div> <span>Direction</span> <span>South&nbsp;West &mdash; &ntilde;</span> </div><div><span>Coastal Condition</span><span>Slight</span></div></div>'
DATA = {"default": "1", "provincial": {"data": {"1": {"name": "North", "psgc_code": "0100", "outlook": [{"day_low": n, "day_high": n + 5, "day_wind_speed": "w"} for n in (20, 21, 22, 23)]}}}}


def page(issued, days):
    body = "".join(ITEM.format(day=d) for d in days)
    return f"<h1>Extended Weather Outlook</h1><span>Issued at: {issued}</span>{body}<ul class=\"nav\">{ITEM.format(day='Later')}</ul><script>let regional  = {json.dumps(DATA)};</script>"


def test_outlook_pages(spark):
    rows = [("a", page("09:00 AM, 26 September, 2026", ["Sunday", "Monday"])), ("b", page("5:00 PM, Sept. 26, 2026", ["Sunday"])), ("c", page("soon", ["Sunday"])), ("d", page("09:00 AM, 26 September, 2026", ["Sunday", " "])), ("e", "nothing"), ("f", None)]
    pages = spark.createDataFrame(rows, "region string, html string")
    days = outlook.region_days(pages, "html")
    got = [(r.region, str(r.issued_at), r.day_index, r.name, r.tmin, r.tmax, r.wind, r.direction, r.coastal, r.sky) for r in days.orderBy("region", "day_index").collect()]
    day = (24, 32, "Light", "South West — ñ", "Slight", "Cloudy & calm")
    assert got == [("a", "2026-09-26 09:00:00", 0, "Sunday", *day), ("a", "2026-09-26 09:00:00", 1, "Monday", *day), ("b", "2026-09-26 17:00:00", 0, "Sunday", *day)]
    provinces = outlook.province_days(pages, "html", days, "region").where("region = 'a'").orderBy("day_index").collect()
    assert [(r.province, r.province_name, r.day, r.tmin, r.tmax) for r in provinces] == [("0100", "North", "Sunday", 21, 26), ("0100", "North", "Monday", 22, 27), ("0100", "North", "", 23, 28)]


def test_long_blocks_end_at_their_mark(spark):
    day = '<div class="outlook-item"><span style="font-weight: bold;">{}</span><i class="low">20</i>{}</div>'
    head, body = "<h1>Extended Weather Outlook</h1><span>Issued at: 5:00 PM, 20 July 2026</span>", day.format("Monday", " " * 30_000) + day.format("Tuesday", "")
    pages = spark.createDataFrame([("marked", f'{head}{body}<ul class="nav">{day.format("Later", "")}'), ("unmarked", head + body)], "region string, html string")
    got = {(r.region, r.name, r.tmin) for r in outlook.region_days(pages, "html").collect()}
    assert got == {("marked", "Monday", 20), ("marked", "Tuesday", 20), ("unmarked", "Monday", 20)}


def test_default_provinces_and_appends(spark):
    rows = [("a", page("09:00 AM, 26 September, 2026", ["Sunday", "Monday"])), ("b", page("5:00 PM, Sept. 26, 2026", ["Sunday"])), ("c", page("soon", ["Sunday"]).replace('"default": "1"', '"default": "9"')), ("d", "nothing"), ("e", None)]
    pages = spark.createDataFrame(rows, "region string, html string")
    got = {r.region: (r.province, r.province_code) for r in outlook.default_provinces(pages, "html").collect()}
    assert got == {"a": ("North", "0100"), "b": ("North", "0100"), "c": ("", ""), "d": ("", ""), "e": ("", "")}
    days = outlook.region_days(pages, "html")
    stored = spark.createDataFrame([("a:2026-09-26T09:00:00",)], "id string")
    assert [(r.id, r.day_index) for r in outlook.append_outlooks(stored, days, "region").collect()] == [("b:2026-09-26T17:00:00", 0)]

"""Web pages to rows. Pages come as a column, so one table of landed pages is parsed by all tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardloom.functions.dates import assumed_year, long_date, loose_date
from hazardloom.functions.text import block_text, bulletin_text, cell_text, cell_texts, clean_link, number, without_hidden


def table_rows(pages: DataFrame, html: str) -> DataFrame:
    """A row per table row: the page's columns but ``html``, and ``row`` (its HTML), ``cells`` (texts) and ``pos``."""
    rows = F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("pos", "row")
    kept = [c for c in pages.columns if c != html]
    cells = cell_texts(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)))
    return pages.select(*kept, rows).withColumn("cells", cells)


def quake_rows(pages: DataFrame, html: str, order: str | None = None) -> DataFrame:
    """Earthquakes: rows of at least six cells with a link to a bulletin and a readable time.

    An id is made of time and place (blank where a coordinate is). Of equal ids the last counts: by the page's ``order``,
    if given, then by place in the page.
    """
    rows = table_rows(pages, html).where("size(cells) >= 6").withColumn("place", F.struct(*([F.col(order).alias("page")] if order else []), "pos")).withColumn("bulletin", clean_link(F.regexp_extract("row", r'(?i)href="([^"]+\.html)"', 1)))
    cell = lambda i: F.get("cells", i)
    named = rows.where("bulletin != ''").withColumn("at", long_date(cell(0))).where("at is not null")
    parsed = named.select("place", "at", number(cell(1)).alias("lat"), number(cell(2)).alias("lon"), number(cell(3)).alias("depth_km"), number(cell(4)).alias("mag"), cell(5).alias("location"), "bulletin")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.concat(F.date_format("at", "yyyyMMdd'T'HHmm"), F.lit("_"), blank("lat"), F.lit("_"), blank("lon"))
    cols = ["at", "lat", "lon", "depth_km", "mag", "location", "bulletin"]
    return parsed.withColumn("event_id", key).groupBy("event_id").agg(F.max_by(F.struct(*cols), "place").alias("r")).select("event_id", "r.*")


def cells_by_id(pages: DataFrame, html: str, fields: list[str]) -> DataFrame:
    """``<td data-id=...>`` cells gathered per id in page order and decoded by position into ``fields``; short ids are null-filled."""
    pattern = r'(?is)<td[^>]*data-id="([^"]*)"[^>]*>(.*?)</td>'
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("id"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("cell"))
    kept = [c for c in pages.columns if c != html]
    flat = pages.select(*kept, F.posexplode(both).alias("pos", "x")).select(*kept, F.col("x.id").alias("id"), F.struct("pos", cell_text(F.col("x.cell")).alias("cell")).alias("c"))
    rows = flat.groupBy(*kept, "id").agg(F.array_sort(F.collect_list("c")).alias("c"))
    return rows.select(*kept, "id", *[F.get(F.col("c.cell"), i).alias(f) for i, f in enumerate(fields)])


def observation_day(label: Column, today: Column) -> Column:
    """``Dec-31`` as a date near ``today``."""
    month = F.month(F.try_to_timestamp(F.concat(F.substring_index(label, "-", 1), F.lit(" 2000")), F.lit("MMM yyyy")))
    return assumed_year(F.substring_index(label, "-", -1).try_cast("int"), month, today)


# The fields of a dam by the place of their cell, and of the day before; None is not told for that day.
DAM_FIELDS = ["obs_time", "rwl_m", "dev_24h_m", "nhwl_m", "dev_nhwl_m", "rule_curve_m", "dev_rule_curve_m", "gates", "gate_opening_m", "inflow_cms", "outflow_cms"]
DAM_TODAY, DAM_BEFORE = [13, 1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12], [23, 14, 15, None, 5, 16, 17, 18, 19, 20, 21, 22]


def dam_days(pages: DataFrame, html: str, today: Column) -> DataFrame:
    """The page's other columns, ``dam, obs_date`` and ``DAM_FIELDS`` as text: a row for the newest day and one for the day before.

    A dam with fewer than 14 cells is left out, one with fewer than 24 has no day before; so is a day without a readable
    date or a level.
    """
    kept = [c for c in pages.columns if c != html]
    cells = cells_by_id(pages, html, [f"c{i}" for i in range(24)])
    day = lambda at: F.struct(observation_day(F.col(f"c{at[0]}"), today).alias("obs_date"), *[(F.lit("") if i is None else F.col(f"c{i}")).alias(f) for i, f in zip(at[1:], DAM_FIELDS, strict=True)])
    days = F.array_compact(F.array(F.when(F.col("c13").isNotNull(), day(DAM_TODAY)), F.when(F.col("c23").isNotNull(), day(DAM_BEFORE))))
    return cells.select(*kept, F.col("id").alias("dam"), F.explode(days).alias("d")).select(*kept, "dam", "d.*").where("obs_date is not null and rwl_m != ''")


def basin_status(html: Column) -> Column:
    """Sub-basins and their status, from rows of a name and a linked status."""
    pattern = F.lit(r"(?is)<tr>\s*<td>([^<]+?Sub-basin)</td>\s*<td[^>]*>\s*<a[^>]*>([^<]+)</a>")
    columns = [cell_texts(F.regexp_extract_all(html, pattern, F.lit(k))) for k in (1, 2)]
    return F.transform(F.arrays_zip(columns[0].alias("name"), columns[1].alias("status")), lambda x: F.struct(x["name"].alias("sub_basin"), x["status"].alias("status")))


# The elements of a regional page that hold advisories, and their kind.
ADVISORIES = {"rainfalls": "rainfall", "thunderstorms": "thunderstorm"}


def has_layout(html: Column) -> Column:
    """Whether a regional page still has both of its parts; where not, its layout has changed and it should not be read."""
    return F.coalesce(html.contains('id="rainfalls"') & html.contains('id="thunderstorms"'), F.lit(False))


def advisories(pages: DataFrame, html: str, region: str) -> DataFrame:
    """``id, region, kind, title, number, issued_at, text`` of each advisory of regional pages; no number is empty, no issue time null.

    Texts of fewer than 40 characters, and those that begin with there being none, are no advisories. The id is made of
    the region, kind, issue time and number (``na`` where missing) and a hash of the text.
    """
    parts = [pages.select(F.col(region).alias("region"), F.lit(kind).alias("kind"), inner_html(F.col(html), element).alias("part")) for element, kind in ADVISORIES.items()]
    items = parts[0].unionByName(parts[1]).select("region", "kind", F.explode(F.split("part", r"(?i)</div>\s*<div[^>]*>")).alias("item"))
    named = items.select("region", "kind", block_text(F.col("item")).alias("text")).where((F.length("text") >= 40) & ~F.left("text", F.lit(200)).rlike("(?i)there is no .{0,60}(?:issued|warning|advisory)"))
    title = F.substring_index("text", "\n", 1)
    issued = r"(?i)Issued at:?\s*([0-9: ]+[AP]M),?\s*(\d{1,2}\s+\w+\s+\d{4})"
    at = loose_date(F.concat_ws(" ", F.regexp_extract("text", issued, 1), F.regexp_extract("text", issued, 2)))
    out = named.withColumns({"title": title, "number": F.regexp_extract(title, r"(?i)\bNo\.?\s*(\d+[A-Z]?)", 1), "issued_at": at})
    when = F.coalesce(F.date_format("issued_at", "yyyy-MM-dd'T'HH:mm:00'+08:00'"), F.lit("na"))
    number = F.coalesce(F.nullif("number", F.lit("")), F.lit("na"))
    return out.select(F.concat_ws(":", "region", "kind", when, number, F.left(F.sha2("text", 256), F.lit(12))).alias("id"), "region", "kind", "title", "number", "issued_at", "text")


def _tabs(html: Column) -> Column:
    """The tabs of a page's article, or all of it where there are none."""
    article = r'(?is)^.*?<div class="[^"]*article-content[^"]*">'
    body = F.regexp_replace(F.regexp_replace(html, article, ""), r"(?is)(?:We always find ways to improve|<footer).*", "")
    tabs = F.split(without_hidden(body), r'(?i)<div[^>]*\bclass="[^"]*\btab-pane\b[^"]*"[^>]*>')
    return F.when(F.size(tabs) > 1, F.slice(tabs, F.lit(2), F.greatest(F.size(tabs) - 1, F.lit(1)))).otherwise(tabs)


def bulletin_rows(pages: DataFrame, html: str) -> DataFrame:
    """The page's other columns, ``pos``, ``sha`` (16 digits of the text's hash) and ``text`` of each cyclone bulletin, one for each tab.

    Only the article counts, up to what the site says below it. A tab that names no active cyclone, or holds fewer than
    200 characters, is no bulletin.
    """
    kept = [c for c in pages.columns if c != html]
    tabs = pages.select(*kept, F.posexplode(_tabs(F.col(html))).alias("pos", "tab"))
    texts = tabs.select(*kept, "pos", bulletin_text(block_text(F.col("tab"))).alias("text"))
    live = texts.where((F.length("text") >= 200) & ~F.col("text").rlike("(?i)No Active Tropical Cyclone"))
    return live.select(*kept, "pos", F.left(F.sha2("text", 256), F.lit(16)).alias("sha"), "text")


def stations(body: Column) -> Column:
    """An array of stations from a JSON body: code, name, level (null where it is no number) and flag."""
    raw = F.from_json(body, "array<struct<obscd: string, obsnm: string, wl: string, alertwl: string, alarmwl: string, criticalwl: string>>")
    level = lambda x: number(F.regexp_extract(x["wl"], r"^([^(]*)", 1))
    flag = lambda x: F.regexp_extract(x["wl"], r"\(([^)]*)\)", 1)
    shaped = F.transform(raw, lambda x: F.struct(x["obscd"].alias("code"), x["obsnm"].alias("name"), level(x).alias("level"), flag(x).alias("flag"), number(x["alertwl"]).alias("alert"), number(x["alarmwl"]).alias("alarm"), number(x["criticalwl"]).alias("critical")))
    return F.filter(shaped, lambda x: x["level"].isNotNull())


def named_levels(html: Column) -> Column:
    """``<span>Name - 2</span>`` as an array of name and level."""
    pattern = F.lit(r"(?is)<span[^>]*>\s*([^<]+?)\s*-\s*(\d)\s*</span>")
    return F.transform(F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("name"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("level")), lambda x: F.struct(x["name"].alias("name"), x["level"].cast("int").alias("level")))


#: Comments and scripts as they are, else a tag: whether it ends an element, the element's name, the rest of the tag.
_MARKUP = re.compile(r"""<!--.*?-->|<script\b.*?</script\s*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*)>""", re.DOTALL | re.IGNORECASE)


def _slice_of(page: str, element_id: str) -> str | None:
    """The source between the tag that has the id and the end tag that closes it, or the page's end."""
    has_id = re.compile(rf"""(?:^|\s)id\s*=\s*(?:"{re.escape(element_id)}"|'{re.escape(element_id)}'|{re.escape(element_id)}(?=[\s/]|$))""", re.IGNORECASE)
    start, kind, depth = None, "", 0
    for tag in _MARKUP.finditer(page):
        ends, name, rest = tag.groups()
        if name is None:
            continue
        if start is None:
            if not ends and has_id.search(rest):
                start, kind, depth = tag.end(), name.lower(), 1
        elif name.lower() == kind and not rest.endswith("/"):
            depth += -1 if ends else 1
            if depth == 0:
                return page[start : tag.start()]
    return None if start is None else page[start:]


def inner_html(html: Column, element_id: str) -> Column:
    """The HTML inside the element of an id, nested elements of its kind counted; null where there is none."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda page: _slice_of(page or "", element_id))

    return run(html)


def embedded_json(html: Column, name: str) -> Column:
    """The object that a script assigns to ``name``, as JSON text: braces are matched outside strings."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import json
        import re

        start, decoder = re.compile(rf"\b(?:let|var|const)\s+{re.escape(name)}\s*=\s*(?={{)"), json.JSONDecoder()

        def one(page: str | None) -> str | None:
            found = start.search(page or "")
            try:
                return json.dumps(decoder.raw_decode(page, found.end())[0], ensure_ascii=False) if found else None
            except ValueError:
                return None

        for part in parts:
            yield part.map(one)

    return run(html)

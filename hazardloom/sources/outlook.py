"""Extended forecasts on regional pages: days of the region, and of each province from the page's script."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardloom.functions.dates import loose_date
from hazardloom.functions.text import cell_text, cell_texts
from hazardloom.sources.pages import embedded_json

# The page format of forecasts - head, end and extent (where no end is found) of the block, and the patterns of its values.
HEAD, LONGEST, ISSUED_WITHIN = "Extended Weather Outlook", 20_000, 600
END = r'(?is)(?:<ul class="nav|id="rainfalls"|<script).*'
ISSUED = r"(?i)Issued\s+at\s*:?\s*(\d{1,2}\s*:\s*\d{2}\s*[AP]\.?M\.?\s*,?\s*(?:\d{1,2}\s+[A-Za-z]+\.?|[A-Za-z]+\.?\s+\d{1,2})\s*,?\s*\d{4})"
ITEM = '(?i)<div class="outlook-item"'
DAY_NAME = r'(?is)<span style="font-weight:\s*bold;?">(.*?)</span>'
LOW, HIGH = r'class="low">\s*(-?\d+)', r'class="high">\s*(-?\d+)'
SKY = r'(?i)<img[^>]*\btitle="([^"]*)"'
_PROVINCES = (
    "struct<default: string, provincial: struct<data: map<string, struct<name: string, psgc_code: string, outlook: array<struct<"
    "day_low: int, day_high: int, day_wind_speed: string, day_wind_direction: string, day_coastal_condition: string>>>>>>"
)


def _found(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, pattern, 1)


def _labelled(label: str) -> str:
    return rf"(?is)<div>\s*<span>[^<]*{label}[^<]*</span>\s*<span>(.*?)</span>\s*</div>"


#: The texts of a day and where they stand in its item.
TEXTS = {"name": DAY_NAME, "wind": _labelled(r"(?i:wind\s*speed)"), "direction": _labelled("(?i:direction)"), "coastal": _labelled("(?i:coastal)"), "sky": SKY}


def region_days(pages: DataFrame, html: str) -> DataFrame:
    """A row per forecast day: the page's columns but ``html``, ``issued_at``, ``day_index`` and the day's values.

    A page counts as a whole: without an issue time, or with a day without a name, it gives no rows.
    """
    kept = [c for c in pages.columns if c != html]
    at = F.locate(HEAD, F.col(html))
    tail = F.when(at > 0, F.substring(html, at, F.length(html)))
    block = F.when(F.regexp_like(tail, F.lit(END)), F.regexp_replace(tail, END, "")).otherwise(F.substring(tail, 1, LONGEST))
    said = F.regexp_replace(_found(cell_text(F.substring(block, 1, ISSUED_WITHIN)), ISSUED), r"\s*:\s*", ":")
    ordered = F.regexp_replace(said, r"([A-Za-z]{3,})\.? (\d{1,2}),? (\d{4})$", "$2 $1 $3")
    items = F.filter(F.split(block, ITEM), lambda _, i: i > 0)
    rows = pages.select(*kept, loose_date(ordered).alias("issued_at"), items.alias("items")).where("issued_at is not null and size(items) > 0")
    # The texts of a page's days are decoded together, one array for each of them.
    each = lambda pattern: F.transform("items", lambda x: _found(x, pattern))
    texts = {c: cell_texts(each(pattern)) for c, pattern in TEXTS.items()}
    read = rows.withColumns(texts | {c: F.transform(each(pattern), lambda x: x.try_cast("int")) for c, pattern in (("tmin", LOW), ("tmax", HIGH))})
    order = ("name", "tmin", "tmax", "wind", "direction", "coastal", "sky")
    days = read.where(F.forall("name", lambda x: x != "")).select(*kept, "issued_at", F.posexplode(F.arrays_zip(*order)).alias("day_index", "day"))
    return days.select(*kept, "issued_at", "day_index", *[F.col(f"day.{c}").alias(c) for c in order])


def province_days(pages: DataFrame, html: str, days: DataFrame, key: str) -> DataFrame:
    """A row per province and forecast day, from the page's script; the first entry there is today's and left out.

    A day has the name of the region's day of the same number, empty where the region has none.
    """
    data = F.from_json(embedded_json(F.col(html), "regional"), _PROVINCES)
    each = pages.select(key, F.explode(data["provincial"]["data"]).alias("code", "p"))
    rows = each.select(key, F.coalesce("p.psgc_code", "code").alias("province"), F.col("p.name").alias("province_name"), F.posexplode(F.filter("p.outlook", lambda _, i: i > 0)).alias("day_index", "d"))
    named = days.select(key, "day_index", F.col("name").alias("day"))
    out = rows.join(named, [key, "day_index"], "left")
    return out.select(key, "province", "province_name", "day_index", F.coalesce("day", F.lit("")).alias("day"), F.col("d.day_low").alias("tmin"), F.col("d.day_high").alias("tmax"), F.col("d.day_wind_speed").alias("wind"), F.col("d.day_wind_direction").alias("direction"), F.col("d.day_coastal_condition").alias("coastal"))


def default_provinces(pages: DataFrame, html: str) -> DataFrame:
    """The page's other columns, and ``province, province_code`` of the province that its script names as the default; empty where it names none."""
    kept = [c for c in pages.columns if c != html]
    data = F.from_json(embedded_json(F.col(html), "regional"), _PROVINCES)
    entry = F.try_element_at(data["provincial"]["data"], F.coalesce(data["default"], F.lit("")))
    text = lambda c: F.coalesce(c, F.lit(""))
    return pages.select(*kept, text(entry["name"]).alias("province"), text(entry["psgc_code"]).alias("province_code"))


def append_outlooks(stored: DataFrame, days: DataFrame, key: str) -> DataFrame:
    """The ``days`` (of ``region_days``) of outlooks that ``stored`` (with ``id``) does not have, with their ``id``.

    An outlook's id is its region and issue time. Pages that could not be read have no days, so one of them never keeps
    the others from being stored.
    """
    named = days.withColumn("id", F.concat_ws(":", F.col(key), F.date_format("issued_at", "yyyy-MM-dd'T'HH:mm:ss")))
    return named.join(stored.select("id").distinct(), "id", "left_anti").select("id", *days.columns)

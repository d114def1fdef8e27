"""Statistics per key, windows that end at the newest row, and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.functions.dates import stamp
from hazardloom.functions.geo import within


def newest(df: DataFrame, at: str) -> Column:
    """The greatest value of ``at``, as a scalar subquery."""
    return df.agg(F.max(at)).scalar()


def key_stats(df: DataFrame, key: str, value: str, at: str, tie: str, least: float) -> DataFrame:
    """Count, count from ``least`` on, maximum (at least 0) and when it was first reached, first and last time."""
    # struct order: greatest value first, then earliest
    top = F.min(F.struct((-F.coalesce(F.col(value), F.lit(0.0))).alias("v"), F.col(at).alias("t"), F.col(tie))).alias("top")
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) >= least).alias("n_strong"), F.greatest(F.lit(0.0), F.max(value)).alias("max_value"), top, F.min(at).alias("a"), F.max(at).alias("z"))
    return out.select(key, "n", "n_strong", "max_value", F.when(F.col("max_value") > 0, stamp("top.t")).alias("max_at"), stamp("a").alias("first_at"), stamp("z").alias("last_at"))


def year_counts(df: DataFrame, key: str, at: str, strong: Column) -> DataFrame:
    return df.groupBy(key, F.year(at).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count_if(strong).alias("n_strong"))


def bands_to_newest(df: DataFrame, key: str, value: str, at: str, edges: tuple[float, float, float], days: int) -> DataFrame:
    """Counts per band of ``value``, and count and maximum of the last ``days`` days before the newest row (strictly)."""
    low, mid, high = edges
    v, late = F.col(value), F.col(at) > newest(df, at) - F.expr(f"interval {days} days")
    return df.groupBy(key).agg(
        F.count_if(v < low).alias("below"), F.count_if((v >= low) & (v < mid)).alias("band_low"), F.count_if((v >= mid) & (v < high)).alias("band_mid"), F.count_if(v >= high).alias("above"),
        F.count_if(late).alias("n_late"), F.max(F.when(late, v)).alias("max_late"),
    )


def month_window(df: DataFrame, key: str, at: str, months: int, strong: Column) -> DataFrame:
    """Counts per key and month, of the ``months`` calendar months that end with the newest row's; months without rows are absent."""
    first = F.add_months(F.trunc(newest(df, at).cast("date"), "MM"), 1 - months)
    return df.where(F.col(at).cast("date") >= first).groupBy(key, F.date_format(at, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_if(strong).alias("n_strong"))


def dense_daily(df: DataFrame, at: str) -> DataFrame:
    """Rows per day from the first day to the last, days without rows with 0."""
    days = df.agg(F.min(F.to_date(at)).alias("a"), F.max(F.to_date(at)).alias("z")).where("a is not null").select(F.explode(F.expr("sequence(a, z, interval 1 day)")).alias("day"))
    counts = df.groupBy(F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


def radius_rates(places: DataFrame, events: DataFrame, key: str, since: str, km: float = 50.0, today: Column | None = None) -> DataFrame:
    """Base rates around each place: counts of magnitude 3, 4 and 5, last of 4 and 5, Poisson chances, and counts of 4 by year.

    ``by_year`` is a list ``year:count`` from ``since`` to the newest event, years without events with 0. Places without events are kept with zeros. Exposure runs from ``since`` to the newest event, or to ``today`` if that is later, half a year at least.
    """
    sound = events.where((F.col("mag") >= 3) & (F.col("occurred_at") >= F.lit(since).cast("timestamp_ntz")))
    newest_day = events.agg(F.max("occurred_at")).scalar().cast("date")
    until = newest_day if today is None else F.greatest(newest_day, today)
    near = within(places.select(key, "lat", "lon"), sound.select("lat", "lon", "mag", "occurred_at"), km)
    m, at = F.col("mag"), F.col("occurred_at")
    last = lambda least: F.max(F.when(m >= least, at))
    yearly = near.groupBy(key, F.year(at).alias("y")).agg(F.count(F.lit(1)).alias("n3"), F.count_if(m >= 4).alias("n4"), F.count_if(m >= 5).alias("n5"), last(4).alias("l4"), last(5).alias("l5"))
    counted = yearly.groupBy(key).agg(F.sum("n3").alias("n_m3"), F.sum("n4").alias("n_m4"), F.sum("n5").alias("n_m5"), F.max("l4").alias("l4"), F.max("l5").alias("l5"), F.map_from_entries(F.collect_list(F.struct("y", "n4"))).alias("m4"))
    years = F.greatest(F.lit(0.5), F.datediff(until, F.lit(since).cast("date")) / F.lit(365.25))
    out = places.select(key).join(counted, key, "left").withColumns({"years": years, "last_year": F.year(until)})
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rate = F.coalesce(F.col("n_m4"), F.lit(0)) / F.col("years")
    span = F.sequence(F.year(F.lit(since).cast("date")), F.col("last_year"))
    by_year = F.array_join(F.transform(span, lambda y: F.concat_ws(":", y, F.coalesce(F.try_element_at("m4", y), F.lit(0)))), ",")
    return out.select(key, n("n_m3"), n("n_m4"), n("n_m5"), stamp("l4").alias("last_m4"), stamp("l5").alias("last_m5"), by_year.alias("by_year"), F.round("years", 6).alias("years"), F.round(1 - F.exp(-rate * 30 / 365.25), 6).alias("p30"), F.round(1 - F.exp(-rate), 6).alias("p365"))


def year_map(df: DataFrame, key: str, at: str) -> DataFrame:
    """Per key a zero-filled list ``year:count`` from the table's first year to its last."""
    whole = df.agg(F.min(F.year(at)).alias("a"), F.max(F.year(at)).alias("z"))
    counts = df.groupBy(key, F.year(at).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    span = F.explode(F.sequence(whole.select("a").scalar(), whole.select("z").scalar()))
    filled = df.select(key).distinct().withColumn("y", span).join(counts, [key, "y"], "left")
    entry = F.struct("y", F.concat_ws(":", "y", F.coalesce("n", F.lit(0))).alias("t"))
    return filled.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(entry))["t"], ",").alias("by_year"))


def strongest(df: DataFrame, keys: list[str], status: str, ranks: list[str]) -> DataFrame:
    """Per key the status that stands last in ``ranks``; unknown ones rank below all."""
    rank = F.create_map(*[F.lit(x) for i, s in enumerate(ranks) for x in (s, i)])
    return df.groupBy(*keys).agg(F.max_by(status, F.coalesce(F.try_element_at(rank, F.col(status)), F.lit(-1))).alias(status))


def nested_summary(df: DataFrame, key: str, item: str, group: str) -> DataFrame:
    """Per key its items in order, and how many fall in each group, as JSON."""
    per = df.groupBy(key, group).agg(F.count(F.lit(1)).alias("n"), F.collect_list(item).alias("items"))
    return per.groupBy(key).agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list("items"))), ",").alias("items"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(group, "n"))))).alias("groups"),
    )


def once_per_document(df: DataFrame, document: str, place: str) -> DataFrame:
    """In how many documents each place is named, however often in one."""
    return df.select(document, place).distinct().groupBy(place).agg(F.count(F.lit(1)).alias("documents"))


def majority(df: DataFrame, key: str, vote: str, seq: str) -> DataFrame:
    """Per key the most frequent vote; of equal ones that seen first."""
    votes = df.groupBy(key, vote).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"))
    best = votes.groupBy(key).agg(F.max_by(F.struct(vote, "n"), F.struct("n", (-F.col("first")).alias("f"))).alias("b"))
    return best.select(key, F.col(f"b.{vote}").alias(vote), F.col("b.n").alias("n"))


def ambiguous(df: DataFrame, key: str, vote: str) -> DataFrame:
    """Keys with more than one vote, with all counts."""
    votes = df.groupBy(key, vote).agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(key).agg(F.count(F.lit(1)).alias("kinds"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", vote, "n"))), ",").alias("votes")).where("kinds > 1")


def per_key_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__at", at).where("__at = 1").drop("__at")


def latest_per_key(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", at).where(F.col("rank") <= n)


def region_votes(votes: DataFrame, pages: DataFrame, keys: DataFrame, key: str, vote: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """``key, vote, n, page`` of keys: the majority's vote, or where nobody voted that of the last page; and the keys with neither.

    ``n`` is null where a page decided. A vote that differs from the page's is a disagreement.
    """
    best = majority(votes, key, vote, seq)
    last = pages.groupBy(key).agg(F.max_by(vote, seq).alias("page"))
    both = keys.select(key).join(best, key, "left").join(last, key, "left")
    told = F.coalesce(vote, "page")
    return both.where(told.isNotNull()).select(key, told.alias(vote), "n", "page"), both.where(told.isNull()).select(key)

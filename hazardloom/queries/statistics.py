"""Statistics per town, windows to the newest row, rates, votes and digests."""

from pyspark.sql import functions as F

from hazardloom.functions.dates import stamp
from hazardloom.functions.text import row_hash
from hazardloom.operators import aggregates as A
from hazardloom.operators.digests import ordered_digest
from hazardloom.queries import query
from hazardloom.sources.tables import QUAKES_SQL, quakes, spot, table

FMT = "'%Y-%m-%d %H:%M:%S'"


@query(f"""with {QUAKES_SQL}, r as (select *, row_number() over (partition by town order by mag desc, occurred_at, event_id) as k from quakes)
select town, count(*) as n, count(*) filter (mag >= 4) as n_strong, greatest(0.0, max(mag))::double as max_value,
  max(case when k = 1 and mag > 0 then strftime(occurred_at, {FMT}) end) as max_at,
  strftime(min(occurred_at), {FMT}) as first_at, strftime(max(occurred_at), {FMT}) as last_at from r group by town""")
def key_stats(spark, d):
    return A.key_stats(quakes(spark, d), "town", "mag", "occurred_at", "event_id", 4)


@query("""select o_custkey, year(o_orderdate)::int as year, count(*) as n, count(*) filter (o_totalprice >= 300000) as n_strong from orders group by all""")
def key_year_counts(spark, d):
    return A.year_counts(table(spark, d, "orders"), "o_custkey", "o_orderdate", F.col("o_totalprice") >= 300000)


@query(f"""with {QUAKES_SQL}, q as (select *, occurred_at > (select max(occurred_at) from quakes) - interval 7 day as late from quakes)
select town, count(*) filter (mag < 3) as below, count(*) filter (mag >= 3 and mag < 4) as band_low, count(*) filter (mag >= 4 and mag < 5) as band_mid,
  count(*) filter (mag >= 5) as above, count(*) filter (late) as n_late, max(case when late then mag end) as max_late from q group by town""")
def bands_to_newest(spark, d):
    return A.bands_to_newest(quakes(spark, d), "town", "mag", "occurred_at", (3, 4, 5), 7)


@query("""select o_custkey, strftime(o_orderdate, '%Y-%m') as month, count(*) as n, count(*) filter (o_totalprice >= 300000) as n_strong from orders
where o_orderdate::date >= date_trunc('month', (select max(o_orderdate) from orders)) - interval 23 month group by all""")
def key_month_window24(spark, d):
    return A.month_window(table(spark, d, "orders"), "o_custkey", "o_orderdate", 24, F.col("o_totalprice") >= 300000)


@query("""with days as (select unnest(generate_series((select min(o_orderdate)::date from orders), (select max(o_orderdate)::date from orders), interval 1 day))::date as day)
select strftime(day, '%Y-%m-%d') as day, count(o_orderkey) as n from days left join orders on o_orderdate::date = day group by 1""")
def daily_dense(spark, d):
    return A.dense_daily(table(spark, d, "orders"), "o_orderdate")


@query(f"with {QUAKES_SQL} select event_id, mag, strftime(occurred_at, {FMT}) as occurred_at from quakes where coalesce(mag, 0) >= 5.5")
def big_events(spark, d):
    return quakes(spark, d).where(F.coalesce("mag", F.lit(0.0)) >= 5.5).select("event_id", "mag", stamp("occurred_at").alias("occurred_at"))


_NEAR = f"""with {QUAKES_SQL}, towns as (select s_suppkey as town_id, (s_suppkey * 7919 % 14000) / 1000.0::double + 5 as lat, (s_suppkey * 104729 % 9000) / 1000.0::double + 117 as lon from supplier),
near as (select town_id, q.* from towns t join quakes q on mag >= 3 and occurred_at >= timestamp '2024-01-03' and
  ((q.lon - t.lon) * 111.32 * cos(radians(t.lat))) * ((q.lon - t.lon) * 111.32 * cos(radians(t.lat))) + ((q.lat - t.lat) * 110.57) * ((q.lat - t.lat) * 110.57) <= 2500)"""


@query(f"""{_NEAR}, c as (select town_id, count(*) as n3, count(*) filter (mag >= 4) as n4, count(*) filter (mag >= 5) as n5, max(case when mag >= 4 then occurred_at end) as l4, max(case when mag >= 5 then occurred_at end) as l5 from near group by town_id),
span as (select unnest(generate_series(2024, (select max(year(occurred_at)) from quakes))) as y),
m as (select town_id, year(occurred_at) as y, count(*) as n from near where mag >= 4 group by all),
b as (select t.town_id, string_agg(span.y || ':' || coalesce(m.n, 0), ',' order by span.y) as by_year from towns t cross join span left join m on m.town_id = t.town_id and m.y = span.y group by 1),
y as (select greatest(0.5, date_diff('day', date '2024-01-03', max(occurred_at)::date) / 365.25) as years from quakes)
select t.town_id, coalesce(n3, 0) as n_m3, coalesce(n4, 0) as n_m4, coalesce(n5, 0) as n_m5, strftime(l4, {FMT}) as last_m4, strftime(l5, {FMT}) as last_m5, by_year, round(years, 6)::double as years,
  round(1 - exp(-(coalesce(n4, 0) / years) * 30 / 365.25), 6)::double as p30, round(1 - exp(-(coalesce(n4, 0) / years)), 6)::double as p365
from towns t left join c on c.town_id = t.town_id join b on b.town_id = t.town_id cross join y""")
def radius_rates(spark, d):
    towns = spot(table(spark, d, "supplier").select(F.col("s_suppkey").alias("town_id")), "town_id")
    return A.radius_rates(towns, quakes(spark, d), "town_id", "2024-01-03")


@query("""with y as (select o_custkey, year(o_orderdate) as y, count(*) as n from orders group by all),
span as (select unnest(generate_series((select min(year(o_orderdate)) from orders), (select max(year(o_orderdate)) from orders))) as y)
select k.o_custkey, string_agg(span.y || ':' || coalesce(n, 0), ',' order by span.y) as by_year
from (select distinct o_custkey from orders) k cross join span left join y on y.o_custkey = k.o_custkey and y.y = span.y group by 1""")
def year_map(spark, d):
    return A.year_map(table(spark, d, "orders"), "o_custkey", "o_orderdate")


_RANKS = ["signup", "view", "click", "purchase", "error"]


@query("""with r as (select user_id, ts::date as day, event_type, list_position(['signup', 'view', 'click', 'purchase', 'error'], event_type) as k from events)
select user_id, strftime(day, '%Y-%m-%d') as day, max_by(event_type, k) as event_type from r group by user_id, day""")
def status_priority(spark, d):
    e = table(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return A.strongest(e, ["user_id", "day"], "event_type", _RANKS)


@query("""with g as (select o_custkey, o_orderstatus, count(*) as n from orders group by all)
select i.o_custkey, i.items, g2.groups from (select o_custkey, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as items from orders group by 1) i
join (select o_custkey, '{' || string_agg('"' || o_orderstatus || '":' || n, ',' order by o_orderstatus) || '}' as groups from g group by 1) g2 using (o_custkey)""")
def nested_summary(spark, d):
    return A.nested_summary(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderstatus")


@query("select l_suppkey, count(distinct l_orderkey) as documents from lineitem group by l_suppkey")
def distinct_per_document(spark, d):
    return A.once_per_document(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("""with v as (select c_nationkey, c_mktsegment, count(*) as n, min(c_custkey) as f from customer group by all)
select c_nationkey, c_mktsegment, n from v qualify row_number() over (partition by c_nationkey order by n desc, f) = 1""")
def majority_vote(spark, d):
    return A.majority(table(spark, d, "customer"), "c_nationkey", "c_mktsegment", "c_custkey")


@query("""with v as (select p_brand, p_type, count(*) as n from part group by all)
select p_brand, count(*) as kinds, string_agg(p_type || ':' || n, ',' order by p_type || ':' || n) as votes from v group by p_brand having count(*) > 1""")
def ambiguous_keys(spark, d):
    return A.ambiguous(table(spark, d, "part"), "p_brand", "p_type")


@query("select user_id, max_by(event_type, event_id) as event_type from events group by user_id")
def last_write(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))


_HASH = "substr(sha256(concat_ws(chr(31), {})), 1, 16)"
_ORDER_HASH = _HASH.format("coalesce(o_orderkey::varchar, chr(0)), coalesce(o_custkey::varchar, chr(0)), coalesce(o_orderstatus, chr(0)), coalesce(o_orderpriority, chr(0))")


@query(f"""with h as (select strftime(o_orderdate, '%Y-%m') as g, {_ORDER_HASH} as h from orders)
select g as "group", count(*) as n, substr(sha256(string_agg(h, '' order by h)), 1, 16) as digest from h group by g""")
def month_digest(spark, d):
    hashed = row_hash(*map(F.col, ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")))
    return ordered_digest(table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM"), hashed)


@query("""select count(*) as n_rows, count(*) filter (l_returnflag not in ('A', 'N', 'R')) as bad_flag, count(*) filter (l_discount + l_tax > 0.15) as over_sum,
  count(*) filter (l_quantity is null or l_quantity <= 0) as bad_quantity, count(*) filter (l_shipdate is null) as no_date, count(distinct (l_orderkey, l_linenumber)) as distinct_keys from lineitem""")
def quality_counts(spark, d):
    c = F.col
    return table(spark, d, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~c("l_returnflag").isin("A", "N", "R")).alias("bad_flag"), F.count_if(c("l_discount") + c("l_tax") > 0.15).alias("over_sum"),
        F.count_if(c("l_quantity").isNull() | (c("l_quantity") <= 0)).alias("bad_quantity"), F.count_if(c("l_shipdate").isNull()).alias("no_date"), F.count_distinct("l_orderkey", "l_linenumber").alias("distinct_keys"),
    )


@query("""select source, lang, count(*) as n from documents where doc_id not in (select doc_id from labels) group by all order by n desc, source, lang limit 40""")
def unmatched_top(spark, d):
    missed = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    return missed.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source", "lang").limit(40)


@query("""select case when l.doc_id is null then 'miss' when coalesce(d.text, '') = '' then 'empty' else 'hit' end as outcome, count(*) as n
from documents d left join labels l using (doc_id) group by 1""")
def match_quality(spark, d):
    both = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    outcome = F.when(F.col("hit").isNull(), "miss").when(F.coalesce("text", F.lit("")) == "", "empty").otherwise("hit")
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""select strftime(ts, '%Y-%m-%d') as day, sum((json_extract(props, '$.k')::bigint))::bigint as signals, min(event_id) = (select min(event_id) from events where json_extract(props, '$.k')::bigint > 0) as first_ever
from events where json_extract(props, '$.k')::bigint > 0 group by 1""")
def signal_latch(spark, d):
    """Signals per day, and whether the day has the first ever."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = table(spark, d, "events").withColumn("k", k).where("k > 0")
    first = e.agg(F.min("event_id")).scalar()
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.sum("k").alias("signals"), (F.min("event_id") == first).alias("first_ever"))


@query("""with a as (select event_type, date_diff('second', max(ts), (select max(ts) from events)) // 60 as age from events group by 1)
select event_type, age::bigint as age_min, age >= 30 as stale, (select min(age) from a)::bigint as freshest, (select min(age) from a) >= 30 as run from a""")
def freshness(spark, d):
    """Age of each source at the newest event, and whether a fallback is due."""
    e = table(spark, d, "events")
    seconds = F.unix_timestamp(F.date_trunc("second", e.agg(F.max("ts")).scalar()).cast("timestamp")) - F.unix_timestamp(F.date_trunc("second", F.max("ts")).cast("timestamp"))
    ages = e.groupBy("event_type").agg(F.floor(seconds / 60).alias("age_min"))
    least = ages.agg(F.min("age_min")).scalar()
    return ages.select("event_type", "age_min", (F.col("age_min") >= 30).alias("stale"), least.alias("freshest"), (least >= 30).alias("run"))


@query("""select 'orders' as t, count(*) as n from orders union all select 'lineitem', count(*) from lineitem union all select 'customer', count(*) from customer union all select 'events', count(*) from events""")
def table_counts(spark, d):
    one = lambda name: table(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
    return one("orders").unionByName(one("lineitem")).unionByName(one("customer")).unionByName(one("events"))


_VOTES = """v as (select o_custkey as k, o_orderpriority as vote, count(*) as n, min(o_orderkey) as first from orders where o_orderkey % 3 = 0 group by all),
best as (select k, arg_max(vote, (n, -first)) as vote, max(n) as n from v group by k),
last as (select o_custkey as k, arg_max(o_orderpriority, o_orderkey) as page from orders where o_orderkey % 3 = 1 group by k)"""


def _region_votes(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderkey")
    return A.region_votes(o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 3 = 1"), table(spark, d, "customer"), "c_custkey", "o_orderpriority", "o_orderkey")


@query(f"""with {_VOTES} select c_custkey, coalesce(vote, page) as vote, n, page, page is not null and vote is not null and vote != page as disagrees
from customer left join best on best.k = c_custkey left join last on last.k = c_custkey where coalesce(vote, page) is not null""")
def vote_disagreements(spark, d):
    """The vote of most documents per key, filled from pages, and where both disagree."""
    found, _ = _region_votes(spark, d)
    disagrees = F.coalesce(F.col("n").isNotNull() & (F.col("page") != F.col("o_orderpriority")), F.lit(False))
    return found.select("c_custkey", F.col("o_orderpriority").alias("vote"), "n", "page", disagrees.alias("disagrees"))


@query(f"with {_VOTES} select c_custkey from customer where c_custkey not in (select k from best) and c_custkey not in (select k from last)")
def vote_missing(spark, d):
    """Keys that no document and no page tells anything about."""
    return _region_votes(spark, d)[1]

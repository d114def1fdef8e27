"""Point, top-n and range reads of the serving side."""

from pyspark.sql import functions as F

from hazardloom.functions.dates import stamp
from hazardloom.operators.aggregates import latest_per_key, per_key_first
from hazardloom.queries import query
from hazardloom.sources.tables import QUAKES_SQL, quakes, table

FMT = "'%Y-%m-%d %H:%M:%S'"


@query("select user_id, event_id, row_number() over (partition by user_id order by ts desc, event_id desc)::int as rank from events qualify rank <= 20")
def latest_per_town(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id"], 20, F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "rank")


@query(f"select event_id, strftime(ts, {FMT}) as ts from events order by events.ts desc, event_id desc limit 20")
def latest_global(spark, d):
    return table(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id", stamp("ts").alias("ts"))


@query("select event_type, event_id, row_number() over (partition by event_type order by ts desc, event_id desc)::int as rank from events qualify rank <= 5")
def latest_bulletins(spark, d):
    return latest_per_key(table(spark, d, "events"), ["event_type"], 5, F.desc("ts"), F.desc("event_id")).select("event_type", "event_id", "rank")


@query("select user_id, count(*) as total from events group by user_id order by total desc, user_id limit 1")
def busiest_town(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), "user_id").limit(1)


@query("""select o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders where (o_custkey, o_orderdate) in (select (o_custkey, max(o_orderdate)) from orders group by o_custkey)""")
def latest_issue_rows(spark, d):
    """All rows of each key's latest issue: the issue is looked up first."""
    o = table(spark, d, "orders")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return o.join(last, ["o_custkey", "o_orderdate"]).select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""select event_id, user_id from (select *, ts + to_hours((1 + event_id % 6)::int) as expires from events) where expires > (select max(ts) from events) - interval 30 minute order by expires desc, event_id limit 60""")
def active_now(spark, d):
    """Warnings still valid at the newest time, the longest first."""
    e = table(spark, d, "events")
    now = e.agg(F.max("ts")).scalar() - F.expr("interval 30 minutes")
    expires = F.col("ts") + F.make_dt_interval(hours=F.col("event_id") % 6 + 1)
    return e.withColumn("expires", expires).where(F.col("expires") > now).orderBy(F.desc("expires"), "event_id").limit(60).select("event_id", "user_id")


@query("""select a.event_id, s.event_type as source from events a join (select event_type, max(ts) as last_ok from events group by 1) s using (event_type)
where a.ts + to_hours((1 + a.event_id % 6)::int) > s.last_ok""")
def active_by_source(spark, d):
    """Rows whose next issue is due after their source's last good reading."""
    e = table(spark, d, "events")
    status = e.groupBy("event_type").agg(F.max("ts").alias("last_ok"))
    expires = F.col("ts") + F.make_dt_interval(hours=F.col("event_id") % 6 + 1)
    return e.join(status, "event_type").where(expires > F.col("last_ok")).select("event_id", F.col("event_type").alias("source"))


@query("select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, sum(o_totalprice)::double as total from orders where o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1997-07-01' group by 1")
def range_read(spark, d):
    """Months of a range; the bounds reach the scan."""
    o = table(spark, d, "orders").where("o_orderdate >= timestamp_ntz '1997-03-01' and o_orderdate < timestamp_ntz '1997-07-01'")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query(f"with {QUAKES_SQL} select event_id, mag from quakes where town = 7")
def by_key_read(spark, d):
    return quakes(spark, d).where("town = 7").select("event_id", "mag")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linenumber = 1 and l_returnflag = 'R')")
def keyed_delete(spark, d):
    """What is left of a table when the rows of a list of keys are deleted."""
    gone = table(spark, d, "lineitem").where("l_linenumber = 1 and l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(gone, "o_orderkey", "left_anti")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def anti_join(spark, d):
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("select c_custkey, c_mktsegment from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)")
def semi_join(spark, d):
    rich = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(rich, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("select c_nationkey as nation from customer intersect select s_nationkey from supplier")
def intersect_keys(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("select p_partkey as part from part except select l_partkey from lineitem where l_quantity > 45")
def except_keys(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("part")).subtract(table(spark, d, "lineitem").where("l_quantity > 45").select("l_partkey"))


@query("select * exclude (k) from (select text, doc_id, source, row_number() over (partition by text order by doc_id) as k from documents) where k = 1")
def first_wins(spark, d):
    """Of equal texts the one read first."""
    return per_key_first(table(spark, d, "documents").select("text", "doc_id", "source"), ["text"], F.col("doc_id"))


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by event_id desc) as k from events) where k = 1")
def last_wins(spark, d):
    """Month files put together: a key's last row counts."""
    e = table(spark, d, "events")
    files = e.where("ts < timestamp_ntz '2024-01-15'").unionByName(e.where("ts >= timestamp_ntz '2024-01-15'"))
    return per_key_first(files, ["user_id", "event_type"], F.desc("event_id")).select("user_id", "event_type", "event_id")


@query("""with m as (select distinct strftime(o_orderdate, '%Y-%m') as month from orders), r as (select month, row_number() over (order by month desc) as k from m)
select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders where strftime(o_orderdate, '%Y-%m') in (select month from r where k <= 2) group by 1""")
def recent_months(spark, d):
    o = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    recent = o.select("month").distinct().orderBy(F.desc("month")).limit(2)
    return o.join(recent, "month", "left_semi").groupBy("month").agg(F.count(F.lit(1)).alias("n"))

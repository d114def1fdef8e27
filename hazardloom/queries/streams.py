"""Batch twins of the streaming operators."""

from pyspark.sql import functions as F

from hazardloom.queries import query
from hazardloom.sources.tables import table
from hazardloom.streaming.change_only import emitted


@query("""with recursive r as (select user_id, epoch(date_trunc('second', ts))::bigint as "at", event_id, case when value >= 60 then 'high' else 'low' end as level, row_number() over (partition by user_id order by epoch(date_trunc('second', ts))::bigint, event_id) as k from events),
f as (select user_id, "at", event_id, level, k, "at" as last_at, level as last_level, true as sent from r where k = 1
  union all select r.user_id, r."at", r.event_id, r.level, r.k, case when r.level != f.last_level or r."at" - f.last_at >= 86400 then r."at" else f.last_at end,
    case when r.level != f.last_level or r."at" - f.last_at >= 86400 then r.level else f.last_level end, r.level != f.last_level or r."at" - f.last_at >= 86400
  from f join r on r.user_id = f.user_id and r.k = f.k + 1)
select user_id, "at", event_id, level from f where sent""")
def change_only_keepalive(spark, d):
    e = table(spark, d, "events").select("user_id", F.unix_timestamp(F.date_trunc("second", "ts").cast("timestamp")).alias("at"), "event_id", F.when(F.col("value") >= 60, "high").otherwise("low").alias("level"))
    return emitted(e, "user_id", "at", "level", "event_id", 86400)


@query("select event_id, user_id from (select *, row_number() over (partition by user_id, event_type, ts::date order by ts, event_id) as k from events) where k = 1")
def once_per_id(spark, d):
    """The first row of each id (town, kind and day): what an idempotent append keeps."""
    from hazardloom.operators.aggregates import per_key_first

    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return per_key_first(e, ["user_id", "event_type", "day"], F.col("ts"), F.col("event_id")).select("event_id", "user_id")

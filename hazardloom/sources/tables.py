"""Tables as Spark reads them, and the hazard views on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over four tasks a core, by its key: a table in one small file is otherwise read, and all that is made of it worked off, by one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


def spot(df: DataFrame, id_col: str) -> DataFrame:
    """Adds ``lat`` and ``lon``, spread over the archipelago's box by the id."""
    n = F.col(id_col)
    return df.withColumns({"lat": (n * 7919 % 14000) / F.lit(1000.0) + 5, "lon": (n * 104729 % 9000) / F.lit(1000.0) + 117})


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as earthquakes: ``event_id, occurred_at, mag, town, lat, lon``."""
    e = table(spark, sf_dir, "events")
    named = e.select("event_id", F.col("ts").alias("occurred_at"), (F.col("value") / F.lit(60.0)).alias("mag"), F.col("user_id").alias("town"))
    return spot(named, "event_id").select("event_id", "occurred_at", "mag", "town", "lat", "lon")


QUAKES_SQL = """quakes as (select event_id, ts as occurred_at, value / 60.0::double as mag, user_id as town,
  (event_id * 7919 % 14000) / 1000.0::double + 5 as lat, (event_id * 104729 % 9000) / 1000.0::double + 117 as lon from events)"""

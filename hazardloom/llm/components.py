"""Connected components of an edge table, as joins and minima over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import cut, in_few_tasks


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("u").alias("node"), one.alias("up"), none.alias("down")).unionByName(edges.select(F.col("v").alias("node"), none.alias("up"), one.alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").limit(1).count() == 0


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node with an edge; ``root`` is the smallest node that it can reach.

    ``edges`` is read several times, so it should be kept. First each node notes its least neighbour below; its other
    neighbours are linked with that one instead. Nodes that lie below no other are done with that, so the rounds work
    only on what connects hubs, and a hub's own leaves are never gathered: they meet their hub in joins of two plain
    tables, which Spark splits where one key is large. Rounds halve the way up, so their number grows with the logarithm
    of the longest chain; they end in the shared folder. Tasks are as many as the edges need.
    """
    rows = edges.count()
    slim = lambda df: in_few_tasks(df, rows)
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    least = cut(slim(pairs.groupBy("u").agg(F.min("v").alias("m"))))
    others = pairs.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    inner = least.join(pairs.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u", F.col("m").alias("v"))
    now = cut(slim(slim(others.unionByName(inner)).distinct()))
    while not _is_stars(now):
        up = now.groupBy("u").agg(F.min("v").alias("m"))
        met = now.join(up.withColumnRenamed("u", "v"), "v", "left")
        jumped = cut(slim(met.select("u", F.coalesce("m", "v").alias("v")).unionByName(met.where("m is not null").select(F.col("v").alias("u"), F.col("m").alias("v")))))
        low = jumped.groupBy("u").agg(F.min("v").alias("m"))
        rest = jumped.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(slim(slim(low.select("u", F.col("m").alias("v")).unionByName(rest)).distinct()))
    tops = now.select(F.col("u").alias("m"), F.col("v").alias("root"))
    found = slim(least.join(tops, "m", "left").select(F.col("u").alias("node"), F.coalesce("root", "m").alias("root")))
    found = found.unionByName(tops.withColumnRenamed("m", "node"))
    return slim(found.unionByName(found.select(F.col("root").alias("node"), "root")).distinct())

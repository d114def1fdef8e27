"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Texts are equal when nothing but white space (space, tab, line feed, vertical tab, form feed, carriage return)
tells them apart. Three stages combine equal texts, and each groups by digest *and* full normalised content:

1. within each input partition (the map side of the first aggregation),
2. per (digest, content, salt), so that a group that holds a third of all rows is merged by many tasks,
3. per (digest, content) over the at most ``salts`` winners that stage 2 left.

On the way back rows meet their group's winner by digest; the few groups that hold a large share of all rows are broadcast.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.llm.common import WHITE, cut

SALTS = 16
#: Groups of at least one in so many of all rows are hot on the way back to their rows.
HOT = 500
_TOP = (1 << 63) - 1
_STEP, _MARK = Decimal(10**20), Decimal(10**8)


def _rank(id_col: str, text: Column) -> Column:
    """Longest text first, then smallest id, then a mark of the text, as one number of 10 + 20 + 8 digits; a null id comes last.

    The mark tells rows apart that repeat an id with other white space of the same length.
    """
    place = F.coalesce(F.lit(_TOP).cast("decimal(20,0)") - F.col(id_col).cast("decimal(20,0)") + 1, F.lit(0).cast("decimal(20,0)"))
    rank = F.length(text).cast("decimal(10,0)") * F.lit(_STEP).cast("decimal(21,0)") + place
    mark = F.pmod(F.xxhash64(text), F.lit(10**8)).cast("decimal(8,0)")
    return (rank.cast("decimal(30,0)") * F.lit(_MARK).cast("decimal(9,0)")).cast("decimal(38,0)") + mark


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rank = _rank(id_col, text).cast("decimal(38,0)")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.translate(text, WHITE, "").alias("content"), rank.alias("rank")).withColumn("digest", F.sha2("content", 256))


def _decided(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    """``exact_groups`` with the ``rank`` that decides."""
    keyed = _keyed(docs, id_col, text_col)
    best = lambda n: (F.max("rank").alias("rank"), n.alias("group_size"))
    salted = (
        keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(*best(F.count(F.lit(1))))
    )
    whole = salted.repartition("digest").groupBy("digest", "content").agg(*best(F.sum("group_size")))
    mark = F.lit(_MARK).cast("decimal(9,0)")
    place = ((F.col("rank") - F.col("rank") % mark) / mark).cast("decimal(38,0)") % F.lit(_STEP).cast("decimal(21,0)")
    winners = cut(
        whole.withColumn("variants", F.count(F.lit(1)).over(Window.partitionBy("digest"))).select(
            "digest",
            F.when(place != 0, (F.lit(_TOP).cast("decimal(20,0)") + 1 - place).cast("long")).alias("keep_id"),
            F.col("rank").alias("best"),
            "group_size",
            F.when(F.col("variants") > 1, F.col("content")).alias("other"),
        )
    )
    # The digest alone leads back to the winner, unless two contents share one digest: then content decides.
    alone = winners.where(F.col("other").isNull()).drop("other")
    # At most HOT groups can hold a HOT-th of the rows: those are broadcast, and their rows are dealt by id instead.
    hot = alone.where(F.col("group_size") * HOT >= (winners.agg(F.sum("group_size")).first()[0] or 1))
    hot = hot.select("digest", F.col("keep_id").alias("hot_id"), F.col("best").alias("hot_best"), F.col("group_size").alias("hot_size"))
    rows = keyed.select("doc_id", "digest", "rank").join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn("way", F.when(F.col("hot_size").isNotNull(), F.concat(F.lit("#"), F.coalesce("doc_id", F.lit(0)))).otherwise(F.col("digest")))
    met = rows.join(alone.withColumnRenamed("digest", "way"), "way", "left").where("hot_size is not null or group_size is not null")
    kept = F.col("rank") == F.coalesce("hot_best", "best")
    out = met.select("doc_id", "digest", F.when(F.col("hot_size").isNotNull(), F.col("hot_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("hot_size", "group_size").alias("group_size"), kept.alias("kept"), "rank")
    shared = winners.where(F.col("other").isNotNull())
    if not shared.isEmpty():
        twice = keyed.join(shared, "digest").where(F.col("content") == F.col("other")).withColumn("kept", F.col("rank") == F.col("best"))
        out = out.unionByName(twice.select(*out.columns))
    return out.withColumnRenamed("digest", "text_sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the one with the most code points stays, then the smallest id. Null texts count as empty and
    equal each other. An empty table gives an empty result. A null id ranks behind every other id. Of rows that repeat
    the winning id with other white space only the longest is kept; rows that repeat id and text whole cannot be told
    apart, count in ``group_size`` each and are kept alike. Texts may be of any length: each is compared whole. Extra
    columns, of whatever names, are ignored.
    """
    return _decided(docs, id_col, text_col, salts).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text one stays."""
    kept_rows = _decided(docs, id_col, text_col, salts).where("kept").groupBy(F.col("rank").alias("__rank"), F.col("text_sha256").alias("__digest"))
    stay = cut(kept_rows.agg(F.count(F.lit(1)).alias("__times")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumns({"__own_digest": F.sha2(F.translate(text, WHITE, ""), 256), "__own_rank": _rank(id_col, text).cast("decimal(38,0)")})
    kept = rows.join(stay, (F.col("__own_rank") == F.col("__rank")) & (F.col("__own_digest") == F.col("__digest")), "left_semi")
    if not stay.where("__times > 1").isEmpty():
        kept = kept.dropDuplicates(["__own_rank", "__own_digest"])
    return kept.drop("__own_digest", "__own_rank")

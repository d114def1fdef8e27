"""Mixing sources to target weights.

Each document gets a hash-random key. Within its source the keys are cut into ranges of about ``bucket_rows``
documents; word sums of the ranges give every range its offset, and a window inside the range gives every document
the number of words before it. A source is then cut at its budget, after as many whole epochs as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.llm.common import WORD, cut

WEIGHTS = (5, 2, 1)
MOST = 3
BUCKET_ROWS = 1024
SEED = "mix-1:"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, source_col: str, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (one row per source with ``source_size`` and ``docs``) with each one's ``target``.

    Sources in code point order (null last) weigh ``weights`` in turn and share the total of all sizes. Filling up
    from the source that reaches ``most`` times its size first, a source is capped when its share of what is left,
    by weight among the sources that are left, is at least its cap. The windows here run over sources, not documents.
    """
    place = F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__place") - 1) % len(weights) + 1).cast("long")
    all_rows = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("__weight"), "__place").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.sum(c).over(all_rows)
    out = (
        sources.withColumn("__place", place)
        .withColumns({"__weight": weight, "__cap": F.col("source_size") * most})
        .withColumns({"__left": total("source_size") - F.coalesce(F.sum("__cap").over(before), F.lit(0)), "__weights": total("__weight") - F.coalesce(F.sum("__weight").over(before), F.lit(0))})
        .withColumn("__capped", F.col("__left") * F.col("__weight") >= F.col("__cap") * F.col("__weights"))
        .withColumns({"__rest": total("source_size") - total(F.when(F.col("__capped"), F.col("__cap")).otherwise(0)), "__open": total(F.when(~F.col("__capped"), F.col("__weight")).otherwise(0))})
    )
    share = (F.col("__rest") * F.col("__weight")).cast("double") / F.nullif(F.col("__open"), F.lit(0)).cast("double")
    return out.withColumn("target", F.when(F.col("__capped"), F.col("__cap").cast("double")).otherwise(share)).select(source_col, "source_size", "docs", "target")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, most: int = MOST, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs``, all columns, with ``size, source_size, target, taken, copies`` added (existing columns of these names are replaced).

    ``taken`` is the number of words that the mix takes of the document, repeats counted: its source's words add up to
    the rounded target exactly, the document at the cut being taken in part. ``copies`` is the same in whole documents:
    the one at the cut is in if its middle is. No document is taken more than ``most`` times.
    Null and empty texts have size 0; a null source is a source of its own; an empty table gives an empty result. Ties
    of the hash key go by id, then size, then a hash of the text; rows that repeat both id and text are documents each and
    interchangeable. Texts may be of any length. Reruns agree.
    """
    docs = docs.drop("size", "source_size", "target", "taken", "copies")
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))
    keyed = docs.withColumns({"size": words(F.col(text_col)), "__key": key})
    # Text stays out of what is counted: (source, key, size) is written once and read for sums and offsets.
    slim = cut(keyed.select(F.col(source_col).alias("__source"), "__key", "size"))
    sources = source_targets(slim.groupBy("__source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "__source", weights, most)
    ranges = F.greatest(F.lit(1), F.ceil(F.col("docs") / bucket_rows))
    sources = cut(sources.withColumn("__ranges", ranges))
    at = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * F.col("__ranges") / F.lit(1 << 32))
    same = F.col("__source").eqNullSafe(F.col("__s"))
    counted = slim.join(sources.select(F.col("__source").alias("__s"), "__ranges"), same).groupBy("__source", at.alias("__range")).agg(F.sum("size").alias("__words"))
    earlier = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(F.col("__source").alias("__os"), F.col("__range").alias("__or"), F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__offset"))

    named = keyed.withColumn("__source", F.col(source_col)).join(sources.withColumnRenamed("__source", "__s"), same).withColumn("__range", at)
    inside = Window.partitionBy("__source", "__range").orderBy("__key", F.col(id_col).asc_nulls_last(), "size", F.xxhash64(F.col(text_col).cast("string"))).rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, F.col("__source").eqNullSafe(F.col("__os")) & (F.col("__range") == F.col("__or")))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.coalesce(F.floor(budget / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    placed = placed.withColumns({"__before": F.col("__offset") + F.col("__inside"), "__epochs": epochs, "__rest": budget - epochs * F.col("source_size")})
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - F.col("__before")))
    return placed.withColumns(
        {
            "taken": (F.col("__epochs") * F.col("size") + part).cast("long"),
            "copies": (F.col("__epochs") + (2 * F.col("__before") + F.col("size") <= 2 * F.col("__rest")).cast("long") * (F.col("__rest") > 0).cast("long")).cast("int"),
        }
    ).select(*docs.columns, "size", "source_size", "target", "taken", "copies")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus in the columns of ``docs``: each document as often as its ``copies`` say."""
    return mix_plan(docs, **how).where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)

"""What each filter removes, and in which order: an audit of interacting document filters.

Every document gets one failure flag per filter. ``CUBE`` over the flags and the part counts documents for every subset
of flags at once: in the grouping set of a subset, the row whose flags are all false counts the documents that *survive*
the filters of that subset. A filter at some step of some order then is a pair of subsets, those before it and those
with it, and the step's figures are the difference of the two survivors' rows; nothing is filtered order by order.

Flags, labels and copies of texts are counted per text before the cube, so the cube reads one row per combination of
flags and part, however many documents there are.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.llm.common import UPPER, WHITE, cut

FILTERS = "ABCDE"
_COUNTS = ("n", "good", "toxic")


def text_flags(text: Column, words: Column) -> dict[str, Column]:
    """The failure conditions that a text decides alone: A few words, B repeated words, C capitals, D special characters."""
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def flag_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, A, B, C, D, E, n, good, toxic``: documents per part and combination of failed filters.

    E marks a text that a row of a smaller id has too, anywhere in the table. Null texts count as empty, null parts as
    the empty string; a row without an id is never a copy and no copy's original, and has no label. Rows that repeat an
    id count each, and are copies only of smaller ids; an id that is labelled twice is good or toxic if one label says
    so. Texts are of any length and compared whole, by SHA-256. Extra columns of any name are ignored.
    """
    text, bare = F.col("text"), F.btrim("text", F.lit(WHITE))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))
    rows = rows.select("id", "part", F.unhex(F.sha2(text, 256)).alias("digest"), *(c.alias(f) for f, c in text_flags(text, F.col("words")).items()))
    # Equal rows meet first, on the map side too: a hot text or id is a few rows from here on.
    rows = rows.groupBy("id", "digest", "part", *"ABCD").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Of one text, part and label only the smallest id can be an original.
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    unnamed = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))
    groups = rows.groupBy("digest", "part", *"ABCD", "good", "toxic").agg(first.alias("first"), unnamed.alias("unnamed"), F.sum("n").alias("n"))
    # A text has a few rows left: one for each part and label.
    groups = groups.withColumn("least", F.min("first.id").over(Window.partitionBy("digest")))
    kept = F.col("unnamed") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    sides = F.explode(F.array(F.struct(F.lit(False).alias("E"), kept.alias("n")), F.struct(F.lit(True).alias("E"), (F.col("n") - kept).alias("n"))))
    counts = groups.select("part", *"ABCD", "good", "toxic", sides.alias("side")).where("side.n > 0").select("part", *"ABCD", "side.E", "side.n", "good", "toxic")
    return counts.groupBy("part", *FILTERS).agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def survivors(counts: DataFrame) -> DataFrame:
    """``part, subset, n, good, toxic`` for every part and each of the 32 subsets of filters (as bits, A the lowest), zeros included."""
    flags, spark = ", ".join(FILTERS), counts.sparkSession
    sums = ", ".join(f"sum({c}) as {c}" for c in _COUNTS)
    subset = " + ".join(f"(1 - grouping({f})) * {1 << i}" for i, f in enumerate(FILTERS))
    cube = spark.sql(f"select part, {flags}, {subset} as subset, grouping(part) as all_parts, {sums} from {{counts}} group by cube ({flags}, part)", counts=counts)
    passed = cube.where("all_parts = 0 and " + " and ".join(f"not coalesce({f}, false)" for f in FILTERS)).select("part", "subset", *_COUNTS)
    wanted = passed.where("subset = 0").select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("subset"))
    return wanted.join(passed, ["part", "subset"], "left").select("part", "subset", *(F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS))


def steps(filters: str = FILTERS) -> list[tuple[str, int, str, int, int]]:
    """Every step of every order: ``filter_order, step, filter, subset before, subset after``."""
    found = []
    for order in itertools.permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << filters.index(f)
            found.append(("".join(order), step, f, before, after))
            before = after
    return found


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the five filters and step; see ``flag_counts`` for awkward rows.

    ``kept`` documents are left after the step and ``removed`` ones went in it; ``redundant`` ones fail its filter but
    had gone before; ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` are the removed ones with
    that label; ``shapley`` is what the filter removes, summed over all orders. An empty table gives an empty result.
    """
    left = cut(survivors(cut(flag_counts(docs, labels, **columns))))
    plan = docs.sparkSession.createDataFrame(steps(), "filter_order string, step int, filter string, before int, after int")
    before = left.select("part", F.col("subset").alias("before"), *(F.col(c).alias(f"{c}_before") for c in _COUNTS))
    after = left.select("part", F.col("subset").alias("after"), *_COUNTS)
    # The plan is 600 rows, whatever the data.
    pairs = before.join(F.broadcast(plan), "before").join(after, ["part", "after"]).withColumn("removed", F.col("n_before") - F.col("n"))
    own = ["part", "filter"]
    of_filter = pairs.groupBy(*own).agg(
        F.sum("removed").alias("shapley"),
        F.max(F.when(F.col("step") == 1, F.col("removed"))).alias("fails"),
        F.max(F.when(F.col("step") == len(FILTERS), F.col("removed"))).alias("unique_fails"),
    )
    return pairs.join(of_filter, own).select(
        "part", "filter_order", "step", F.col("n").alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        (F.col("good_before") - F.col("good")).alias("good_lost"), (F.col("toxic_before") - F.col("toxic")).alias("toxic_lost"), "shapley",
    )

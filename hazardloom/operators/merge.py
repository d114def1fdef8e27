"""Keyed merges, differences by hash, high watermark and group digest, and the delivery plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.functions.text import row_hash


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of equal keys, blanks included, and ``change``: same, update or insert.

    Of rows of ``new`` with equal keys the last in ``order`` counts (without it, in the order that they are read in).
    """
    values = [c for c in old.columns if c not in keys]
    left = old.select(*keys, F.struct(*values).alias("__o"))
    ranked = new.withColumn("__at", F.monotonically_increasing_id() if order is None else order)
    right = ranked.groupBy(*keys).agg(F.max_by(F.struct(*values), "__at").alias("__n"))
    both = left.join(right, keys, "full_outer")
    change = F.when(F.col("__n").isNull() | F.col("__n").eqNullSafe(F.col("__o")), "same").when(F.col("__o").isNull(), "insert").otherwise("update")
    taken = F.coalesce("__n", "__o")
    return both.select(*keys, *[taken[c].alias(c) for c in values], change.alias("change"))


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of ``new`` whose key ``old`` does not have; keys that ``new`` repeats stay repeated."""
    return new.join(old.select(key).distinct(), key, "left_anti")


def compact_texts(rows: DataFrame, text: str, order: str, *kept: str) -> DataFrame:
    """Of rows with equal ``text`` the first in ``order``, with its ``kept`` columns, and how many there were as ``n``.

    Texts are grouped by their SHA-256; compacting twice changes nothing but ``n``.
    """
    first = F.min_by(F.struct(text, order, *kept), order).alias("r")
    return rows.groupBy(F.sha2(text, 256).alias("__digest")).agg(first, F.count(F.lit(1)).alias("n")).select("r.*", "n")


def replace_guarded(old: DataFrame, new: DataFrame, group: str, least: float = 0.95) -> DataFrame:
    """Per group whether ``new`` may replace ``old`` (not with fewer than ``least`` of its rows), and how many rows change."""
    cols = old.columns
    have = old.groupBy(group).agg(F.count(F.lit(1)).alias("n_old"))
    come = new.groupBy(group).agg(F.count(F.lit(1)).alias("n_new"))
    added = new.join(old, [new[c].eqNullSafe(old[c]) for c in cols], "left_anti").groupBy(group).agg(F.count(F.lit(1)).alias("added"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = have.join(come, group, "full_outer").join(added, group, "left")
    ok = zero("n_new") >= zero("n_old") * least
    return both.select(group, zero("n_old").alias("n_old"), zero("n_new").alias("n_new"), ok.alias("replaced"), F.when(ok, zero("added") + F.greatest(F.lit(0), zero("n_old") - zero("n_new"))).otherwise(0).alias("changed"))


def rowhash_diff(old: DataFrame, new: DataFrame, keys: list[str], deletes: bool = True) -> DataFrame:
    """``keys, change`` for rows that are new, changed or (if wanted) gone."""
    hashed = lambda df, name: df.select(*keys, row_hash(*[F.col(c) for c in df.columns]).alias(name))
    both = hashed(old, "o").join(hashed(new, "n"), keys, "full_outer")
    change = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete").otherwise("update")
    out = both.where(~F.col("o").eqNullSafe(F.col("n"))).select(*keys, change.alias("change"))
    return out if deletes else out.where("change != 'delete'")


def past_watermark(df: DataFrame, at: str, sent_until: Column) -> DataFrame:
    """The rows strictly past the mark; late rows, and those without a time, are never sent."""
    return df.where(F.col(at) > sent_until)


def digest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per group of two digest tables (``group, n, digest``): new, changed, same or gone."""
    both = old.select("group", F.col("digest").alias("o")).join(new.select("group", "n", F.col("digest").alias("d")), "group", "full_outer")
    state = F.when(F.col("o").isNull(), "new").when(F.col("d").isNull(), "gone").when(F.col("o") == F.col("d"), "same").otherwise("changed")
    return both.select("group", F.coalesce("n", F.lit(0)).alias("n"), state.alias("state"))


def month_changes(old_digests: DataFrame, old_rows: DataFrame, new_digests: DataFrame, new_rows: DataFrame, key: str) -> DataFrame:
    """``group, key, change``: what a delivery of the changed groups sends. Rows are ``group, key, hash``.

    Groups of equal digests send nothing. Of a group whose old rows are known, only rows that are new, changed or gone
    are sent; any other is sent whole, and cleared before (``clear``, without a key) if it was sent once. Groups that
    are gone as a whole stay as they are.
    """
    known = old_rows.select("group").distinct().withColumn("known", F.lit(True))
    states = digest_diff(old_digests, new_digests).where("state in ('new', 'changed')").join(known, "group", "left").select("group", "state", F.coalesce("known", F.lit(False)).alias("known"))
    come = new_rows.select("group", key, F.col("hash").alias("n")).join(states, "group")
    whole = come.where("not known").select("group", key, F.lit("insert").alias("change"))
    clear = states.where("not known and state = 'changed'").select("group", F.lit(None).cast(new_rows.schema[key].dataType).alias(key), F.lit("clear").alias("change"))
    was = old_rows.select("group", key, F.col("hash").alias("o")).join(states.where("known").select("group"), "group", "left_semi")
    both = was.join(come.where("known").select("group", key, "n"), ["group", key], "full_outer").where("not o <=> n")
    change = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete").otherwise("update")
    return whole.unionByName(clear).unionByName(both.select("group", key, change.alias("change")))


def change_set(old: DataFrame, new: DataFrame, keys: list[str], deletes: bool = True) -> DataFrame:
    """``change`` and all columns of rows to insert, update or (if wanted) delete; a deleted row has its keys alone.

    What ``apply_changes`` makes of ``old`` and this is ``new``; without deletes also the rows that are gone stay.
    """
    values = [c for c in new.columns if c not in keys]
    hashed = lambda df, *more: df.select(*keys, row_hash(*[F.col(c) for c in [*keys, *values]]).alias("__hash"), *more)
    left = hashed(old).withColumnRenamed("__hash", "__old")
    both = left.join(hashed(new, F.struct(*values).alias("__v")), keys, "full_outer").where(~F.col("__old").eqNullSafe(F.col("__hash")))
    change = F.when(F.col("__old").isNull(), "insert").when(F.col("__hash").isNull(), "delete").otherwise("update")
    out = both.select(change.alias("change"), *keys, *[F.col("__v")[c].alias(c) for c in values])
    return out if deletes else out.where("change != 'delete'")


def month_change_set(old_digests: DataFrame, old_rows: DataFrame, new_digests: DataFrame, new: DataFrame, key: str, new_hash: Column, since: Column | None = None) -> DataFrame:
    """``month_changes`` with the values of ``new`` (with ``group`` and the key), ready for ``apply_changes``.

    With ``since`` (a group) a change ``before`` tells to drop the groups below it, which a sliding window left behind.
    """
    changes = month_changes(old_digests, old_rows, new_digests, new.select("group", key, new_hash.alias("hash")), key)
    values = [c for c in new.columns if c not in ("group", key)]
    filled = changes.join(new, ["group", key], "left").select("change", "group", key, *values)
    if since is None:
        return filled
    none = [F.lit(None).cast(new.schema[c].dataType).alias(c) for c in (key, *values)]
    return filled.unionByName(new.sparkSession.range(1).select(F.lit("before").alias("change"), since.alias("group"), *none))


def apply_changes(old: DataFrame, changes: DataFrame, keys: list[str], group: str | None = None) -> DataFrame:
    """``old`` after ``changes`` (``change`` and its columns): insert and update put a row, delete takes the row of the keys.

    With ``group``, ``clear`` first takes all rows of a group and ``before`` those of smaller groups. Applying the same
    changes again changes nothing. One join on the keys; what is cleared does not reach it.
    """
    values = [c for c in old.columns if c not in keys]
    if group:
        old = old.join(changes.where("change = 'clear'").select(group).distinct(), group, "left_anti").select(*old.columns)
        first = changes.where("change = 'before'").agg(F.max(group)).scalar()
        old = old.where(F.coalesce(F.col(group) >= first, F.lit(True)))
    rows = changes.where("change in ('insert', 'update', 'delete')")
    left = old.select(*keys, F.struct(*values).alias("__o"))
    both = left.join(rows.select(*keys, "change", F.struct(*values).alias("__v")), keys, "full_outer").where("change is null or change != 'delete'")
    taken = F.when(F.col("change").isNull(), F.col("__o")).otherwise(F.col("__v"))
    return both.withColumn("__r", taken).select(*[F.col(c) if c in keys else F.col("__r")[c].alias(c) for c in old.columns])


def budget_plan(groups: DataFrame, group: str, rows: str, budget: int, fresh: int = 2) -> DataFrame:
    """Groups from the newest on: the ``fresh`` newest always, then older ones while their rows add up to the budget.

    The first older group that has rows is always taken, groups without rows pass. The windows run over groups.
    """
    newest = Window.orderBy(F.desc(group))
    ranked = groups.withColumn("rank", F.row_number().over(newest)).withColumn("old_rows", F.when(F.col("rank") > fresh, F.col(rows)).otherwise(0))
    upto = newest.rowsBetween(Window.unboundedPreceding, 0)
    summed = ranked.withColumns({"so_far": F.sum("old_rows").over(upto), "with_rows": F.sum((F.col("old_rows") > 0).cast("int")).over(upto)})
    taken = (F.col("rank") <= fresh) | (F.col("old_rows") == 0) | (F.col("so_far") <= budget) | (F.col("with_rows") == 1)
    return summed.withColumn("refused", F.max((~taken).cast("int")).over(upto)).select(group, rows, F.col("rank"), (taken & (F.col("refused") == 0)).alias("taken"))

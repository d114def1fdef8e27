"""Digests of sets of rows that merge: per group, and as a tree over the keys, whose differences are found top down.

A row counts by its hash. The digest of a set is made from the number of its rows and the sums of the two halves of their
hashes, so it needs no order, is summed where the rows are, and the sums of parts are those of the whole. A tree has a
node for each group and each prefix of a hash of the key, down to ``depth`` hexadecimal digits; a row whose values change
stays in its leaf. Two trees are compared level by level, only below nodes that differ, and rows only in leaves that do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 2
_SUMS = ("n", "high", "low")


def _sums(row_hash: Column) -> list[Column]:
    half = lambda at: F.sum(F.conv(F.substring(row_hash, at, 8), 16, 10).cast("decimal(12,0)"))
    return [F.count(F.lit(1)).alias("n"), half(1).alias("high"), half(9).alias("low")]


def _digest() -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in _SUMS]), 256), 1, 16).alias("digest")


def group_digest(df: DataFrame, group: Column, row_hash: Column) -> DataFrame:
    """``group, n, digest`` of the rows' hashes (16 hexadecimal digits); null hashes count as rows alone."""
    return df.groupBy(group.alias("group")).agg(*_sums(row_hash)).select("group", "n", _digest())


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, n, digest = None, 0, None
    row = lambda: pd.DataFrame({"group": pd.Series([now[0]], dtype=object), "n": [n], "digest": [digest.hexdigest()[:16]]})
    for batch in batches:
        for group, part in batch.groupby("group", dropna=False, sort=False)["hash"]:
            at = (None if pd.isna(group) else group,)
            if at != now:
                if now is not None:
                    yield row()
                now, n, digest = at, 0, hashlib.sha256()
            n += len(part)
            digest.update("".join(part.dropna()).encode())
    if now is not None:
        yield row()


def ordered_digest(df: DataFrame, group: Column, row_hash: Column) -> DataFrame:
    """``group, n, digest``: of all the rows' hashes in order, one behind the other; null hashes count as rows alone.

    A digest of a sequence cannot be merged, so the sorted hashes of a group stream through one task, a batch at a time.
    """
    rows = df.select(group.cast("string").alias("group"), row_hash.alias("hash"))
    return rows.repartition("group").sortWithinPartitions("group", "hash").mapInPandas(_streamed, "group string, n long, digest string")


def leaf(key: Column, depth: int = DEPTH) -> Column:
    """The leaf of a key: the first digits of its MD5."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, depth)


def digest_tree(rows: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """``group, prefix, n, digest`` of ``rows`` (``group``, the key and ``hash``), for prefixes of 0 to ``depth`` digits.

    A group of any size is summed in as many tasks as it has rows in.
    """
    leaves = rows.groupBy("group", leaf(F.col(key), depth).alias("leaf")).agg(*_sums(F.col("hash")))
    levels = F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.substring("leaf", F.lit(1), k)))
    return leaves.withColumn("prefix", levels).groupBy("group", "prefix").agg(*(F.sum(c).alias(c) for c in _SUMS)).select("group", "prefix", "n", _digest())


def tree_diff(old: DataFrame, new: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``group, prefix, n_old, n_new`` of the nodes that differ, at every level; a level joins only what lies below differing nodes."""
    # As a struct the null group equals itself in joins.
    level = lambda tree, k: tree.where(F.length("prefix") == k).withColumn("group", F.struct("group"))
    found, above = None, None
    for k in range(depth + 1):
        a, b = level(old, k), level(new, k)
        if above is not None:
            parent = lambda t: t.withColumn("up", F.substring("prefix", 1, k - 1)).join(above, ["group", "up"], "left_semi").drop("up")  # noqa: E731, B023
            a, b = parent(a), parent(b)
        both = a.select("group", "prefix", F.col("n").alias("n_old"), F.col("digest").alias("o")).join(b.select("group", "prefix", F.col("n").alias("n_new"), F.col("digest").alias("d")), ["group", "prefix"], "full_outer")
        differ = both.where(~F.col("o").eqNullSafe(F.col("d"))).select("group", "prefix", F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new"))
        found = differ if found is None else found.unionByName(differ)
        above = differ.select("group", F.col("prefix").alias("up"))
    return found.withColumn("group", F.col("group.group"))


def changed_rows(old: DataFrame, new: DataFrame, differing: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """``group``, the key and ``change`` (insert, update, delete) of rows (``group``, key, ``hash``) in the leaves of ``differing`` (of ``tree_diff``)."""
    leaves = differing.where(F.length("prefix") == depth).select(F.struct("group").alias("group"), F.col("prefix").alias("leaf"))
    inside = lambda rows, name: rows.withColumns({"leaf": leaf(F.col(key), depth), "group": F.struct("group")}).join(leaves, ["group", "leaf"], "left_semi").select("group", key, F.col("hash").alias(name))
    both = inside(old, "o").join(inside(new, "d"), ["group", key], "full_outer").where(~F.col("o").eqNullSafe(F.col("d")))
    return both.select(F.col("group.group").alias("group"), key, F.when(F.col("o").isNull(), "insert").when(F.col("d").isNull(), "delete").otherwise("update").alias("change"))

"""Rows in order, dealt into statements of bounded size, by many tasks for one group.

Each batch begins where the one before is full, so where a batch begins depends on all before it. Rows are range-sorted
and taken in chunks. In a chunk, every row that could begin a batch points to the row that begins the next one, and
following the pointers from the end tells, for each first beginning, how many batches begin in the chunk and how full the
last one is. Chunks are few: going through them in order with these tables gives every chunk the batch that it begins in,
and the chunks then number their rows on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.functions.stored import cut
from hazardloom.functions.text import sql_literal

CHUNK = 8_192


def _next(ends: np.ndarray, most: int) -> np.ndarray:
    """For each row, as the first of a batch, the row that begins the next batch; the number of rows where none does.

    ``ends`` are the sizes summed up, with 0 in front. Rows without size begin no batch behind them by what follows.
    """
    n = len(ends) - 1
    first = np.searchsorted(ends, ends[:-1] + most, side="right") - 1  # the first row that ends beyond the limit
    held = np.searchsorted(ends, ends[:-1], side="right")  # the first row that has something before it
    return np.minimum(np.maximum(first, held), n)


def _first(ends: np.ndarray, n: int, held: int, most: int) -> int:
    """The first of ``n`` rows that begins a new batch, where the batch so far holds ``held`` bytes; ``n`` if none does.

    Of ``ends`` those up to ``most`` and the next one are enough.
    """
    row = int(np.searchsorted(ends, most - held, side="right")) - 1 if held <= most else 0
    if not held:
        row = max(row, int(np.searchsorted(ends, 0, side="right")))
    return min(max(row, 0), n)


def _summary(ends: np.ndarray, most: int) -> tuple[list[int], list[int], list[int]]:
    """Of the rows that can be the first to begin a batch: the row, how full the last batch then ends, how many begin.

    Of neighbouring rows with the same outcome only the last is listed.
    """
    n = len(ends) - 1
    then = _next(ends, most)
    full, count = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    for row in range(n - 1, -1, -1):
        to = then[row]
        full[row], count[row] = (full[to], count[to] + 1) if to < n else (ends[n] - ends[row], 1)
    top = int(np.searchsorted(ends[:-1], max(most, 0), side="right"))
    top = max(top, int(np.searchsorted(ends, 0, side="right")) + 1)
    rows = np.arange(min(top, n))
    last = np.ones(len(rows), dtype=bool)
    last[:-1] = (full[rows[1:]] != full[rows[:-1]]) | (count[rows[1:]] != count[rows[:-1]])
    return rows[last].tolist(), full[rows[last]].tolist(), count[rows[last]].tolist()


def _chunks(group: str, order: str, most: int, size: int):
    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, now, begun, orders, sizes = TaskContext.get().partitionId(), 0, None, False, [], []

        def close() -> tuple:
            ends = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))])
            return (now, part, number, list(orders), list(sizes), ends.tolist(), *_summary(ends, most))

        for batch in batches:
            out = []
            for k, o, s in zip(batch[group].tolist(), batch[order].tolist(), batch["size"].tolist(), strict=True):
                if begun and (k != now or len(sizes) == size):
                    out.append(close())
                    number += 1
                    orders.clear(), sizes.clear()
                now, begun = k, True
                orders.append(o), sizes.append(s)
            yield pd.DataFrame(out, columns=_CHUNK)
        if begun:
            yield pd.DataFrame([close()], columns=_CHUNK)

    return chunks


_CHUNK = ["key", "part", "number", "orders", "sizes", "ends", "rows", "fulls", "counts"]


def _through(most: int):
    def through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The batch and its size with which each chunk of the sorted groups begins."""
        now, begun, batch, held = None, False, 0, 0
        for frame in batches:
            out = []
            for r in frame.itertuples(index=False):
                if not begun or r.key != now:
                    now, begun, batch, held = r.key, True, 0, 0
                out.append((r.key, r.part, r.number, batch, held))
                row = _first(np.asarray(r.heads), r.n, held, most)
                if row < r.n:
                    at = int(np.searchsorted(np.asarray(r.rows), row))
                    batch, held = batch + int(r.counts[at]), min(int(r.fulls[at]), most + 1)
                else:
                    held = min(held + int(r.total), most + 1)
            yield pd.DataFrame(out, columns=["key", "part", "number", "batch", "held"])

    return through


def _number(most: int):
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = []
            for r in frame.itertuples(index=False):
                ends = np.concatenate([[0], np.cumsum(np.asarray(r.sizes, dtype=np.int64))])
                n, then = len(ends) - 1, _next(ends, most)
                begins, row = np.zeros(n, dtype=np.int32), _first(ends, n, int(r.held), most)
                while row < n:
                    begins[row] = 1
                    row = int(then[row])
                found.append(pd.DataFrame({"key": [r.key] * n, "at": list(r.orders), "batch": int(r.batch) + np.cumsum(begins)}))
            yield pd.concat(found) if found else pd.DataFrame([], columns=["key", "at", "batch"])

    return number


def statement_batches(rows: DataFrame, group: str, order: str, text: str, most: int, chunk: int = CHUNK) -> DataFrame:
    """``group, order, batch``: rows of each group, in order, dealt into statements of at most ``most`` bytes.

    A longer row, or one without text, is a statement alone. Batches are numbered from 0; ``order`` is not null. A group's rows lie in as many
    tasks as they need; one small row for each ``chunk`` of them goes through one task, one by one.
    """
    kind, at = dict(rows.dtypes)[group], dict(rows.dtypes)[order]
    # The key as text tells null from the empty text and numbers from missing ones in pandas.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    sized = rows.select(key.alias("key"), order, F.least(F.coalesce(F.octet_length(text), F.lit(most + 1)), F.lit(most + 1)).cast("long").alias("size"))
    ordered = sized.repartitionByRange("key", order).sortWithinPartitions("key", order, "size")
    lists = "ends array<long>, rows array<long>, fulls array<long>, counts array<long>"
    chunks = cut(ordered.mapInPandas(_chunks("key", order, most, chunk), f"key string, part int, number int, orders array<{at}>, sizes array<long>, {lists}"))
    place = ["key", "part", "number"]
    heads = F.slice("ends", F.lit(1), F.size(F.filter("ends", lambda x: x <= most)) + 1)
    summaries = chunks.select(*place, heads.alias("heads"), (F.size("ends") - 1).alias("n"), F.element_at("ends", -1).alias("total"), "rows", "fulls", "counts")
    through = summaries.repartition("key").sortWithinPartitions(*place).mapInPandas(_through(most), "key string, part int, number int, batch int, held long")
    numbered = chunks.select(*place, "orders", "sizes").join(through, place).mapInPandas(_number(most), f"key string, at {at}, batch int")
    return numbered.select(F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).cast(kind).alias(group), F.col("at").alias(order), "batch")


def insert_statements(rows: DataFrame, table: str, columns: list[str], numeric: list[str], group: str, order: str, most: int = 90_000, chunk: int = CHUNK) -> DataFrame:
    """``group, batch, rows, statement``: SQL that puts the rows of each group, in order, at most ``most`` bytes a statement.

    Values are text, or null; those of ``numeric`` columns that are numbers stand bare. A row that is longer than
    ``most`` is a statement alone. A statement is put together from its own rows, which its size bounds.
    """
    head = f"INSERT OR REPLACE INTO {table} ({', '.join(columns)}) VALUES\n"
    value = F.concat(F.lit("("), F.concat_ws(", ", *[sql_literal(F.col(c).cast("string"), c in numeric) for c in columns]), F.lit(")"))
    texts = cut(rows.select(F.col(group).alias("g"), F.col(order).alias("o"), value.alias("value")))
    # Between two rows of a statement stand two more bytes.
    batches = statement_batches(texts.withColumn("sized", F.concat("value", F.lit("  "))), "g", "o", "sized", most - len(head.encode()), chunk)
    met = texts.join(batches.withColumnsRenamed({"g": "b_g", "o": "b_o"}), F.col("g").eqNullSafe(F.col("b_g")) & (F.col("o") == F.col("b_o")))
    listed = F.array_sort(F.collect_list(F.struct("o", "value")))
    text = F.concat(F.lit(head), F.array_join(F.transform(listed, lambda r: r["value"]), ",\n"), F.lit(";"))
    return met.groupBy("g", "batch").agg(F.count(F.lit(1)).alias("rows"), text.alias("statement")).withColumnRenamed("g", group)


def delete_statements(keys: DataFrame, table: str, columns: list[str], numeric: list[str], order: str, most: int = 200, chunk: int = CHUNK) -> DataFrame:
    """``batch, rows, statement``: SQL that deletes the rows of the keys, at most ``most`` of them a statement, by equality on the key."""
    one = F.concat(F.lit("("), F.concat_ws(" AND ", *[F.concat(F.lit(f"{c} = "), sql_literal(F.col(c).cast("string"), c in numeric)) for c in columns]), F.lit(")"))
    texts = cut(keys.select(F.lit("").alias("g"), F.col(order).alias("o"), one.alias("value")))
    batches = statement_batches(texts.withColumn("sized", F.lit("x")), "g", "o", "sized", most, chunk).select("o", "batch")
    listed = F.array_sort(F.collect_list(F.struct("o", "value")))
    text = F.concat(F.lit(f"DELETE FROM {table} WHERE "), F.array_join(F.transform(listed, lambda r: r["value"]), " OR "), F.lit(";"))
    return texts.join(batches, "o").groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), text.alias("statement"))

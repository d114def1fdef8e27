"""Folds over the sorted rows of a key, in constant memory however many rows a key has."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def fold_sorted(df: DataFrame, key: str, order: list[str], schema: StructType, first: Callable[[], list], step: Callable[[list, dict], list[dict]], last: Callable[[list, object], list[dict]] = lambda state, key: []) -> DataFrame:
    """What ``step`` returns for each row, in ``order`` within its key, and ``last`` after a key's last row.

    ``first`` makes a key's state, a list that ``step`` changes in place. Rows of a key stand in one task, sorted by
    Spark, which spills; only the state goes from batch to batch.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, state = False, None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun or row[key] != now:
                    if begun:
                        out += last(state, now)
                    begun, now, state = True, row[key], first()
                out += step(state, row)
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if begun:
            yield pa.RecordBatch.from_pylist(last(state, now), schema=arrow)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)

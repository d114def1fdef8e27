"""Change-only emission with keepalive, as a stateful stream and as a fold over one key's rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hazardloom.functions.folds import fold_sorted

KEEPALIVE_S = 3600


def emitted(df: DataFrame, key: str, at: str, level: str, tie: str, keepalive_s: int = KEEPALIVE_S) -> DataFrame:
    """Per key the rows that a change-only feed emits: the level differs from the last *emitted* one, or that is ``keepalive_s`` old.

    ``at`` is in whole seconds. The fold runs over one key's rows; what is last emitted cannot be told from neighbours.
    """
    rows = df.select(key, F.col(at).cast("long").alias(at), F.col(tie).cast("long").alias(tie), F.col(level).cast("string").alias(level))

    def step(last: list, row: dict) -> list[dict]:
        now, value = row[at], row[level]
        if last[0] is None or value != last[1] or now is not None and now - last[0] >= keepalive_s:
            last[:] = now, value
            return [row]
        return []

    return fold_sorted(rows, key, [at, tie, level], rows.schema, lambda: [None, None], step)


def emitted_stream(stream: DataFrame, key: str, at: str, level: str, tie: str, keepalive_s: int = KEEPALIVE_S) -> DataFrame:
    """The same over a stream: the last emitted level and time of a key are its state."""
    schema = f"{key} long, {at} long, {tie} long, {level} string"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values([at, tie])
        out = []
        for row in rows.itertuples(index=False):
            now, value = int(getattr(row, at)), getattr(row, level)
            if last[0] is None or value != last[1] or now - last[0] >= keepalive_s:
                out.append((int(group[0]), now, int(getattr(row, tie)), value))
                last = (now, value)
        state.update(last)
        yield pd.DataFrame(out, columns=[key, at, tie, level])

    return stream.groupBy(key).applyInPandasWithState(step, schema, "at long, level string", "append", GroupStateTimeout.NoTimeout)


def once_per_id(stream: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """Each id once, however often it is read again within ``delay``."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])

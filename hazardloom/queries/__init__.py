"""Registered queries: operators applied to whole tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add

"""Landed pages as a data source: ``spark.read.format("landed_pages")`` and ``spark.readStream.format("landed_pages")``.

A collector puts pages as ``<source>/<landing time>.<kind>``, the time as ``20260927T110000123456Z`` in UTC. A stream's
offset is a landing time: a micro-batch has the pages that landed behind the last offset, up to the new one, which stays
``settle`` seconds behind the clock, so that a page that is still being put is not passed over. A split has at most
``files`` pages of one source; tasks read them from the shared store themselves. Names of another form are no pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "source string, kind string, landed timestamp, path string, body string"
_NAME = re.compile(r"(\d{8}T\d{12}Z)\.([a-z0-9]+)")
_FORM = "%Y%m%dT%H%M%S%fZ"
_NEVER = "00000000T000000000000Z"


@dataclass
class Split(InputPartition):
    source: str
    names: list[str]


class _Pages:
    def __init__(self, options: dict):
        self.root, self.files, self.settle = options["path"], int(options.get("files", 64)), float(options.get("settle", 2))

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)

    def landed(self, after: str, until: str) -> list[Split]:
        """Splits of the pages that landed behind ``after``, up to ``until``; folders are listed by the driver."""
        from pyarrow import fs

        store, root = self._store()
        found: dict[str, list[str]] = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            source, _, name = info.path.removeprefix(root.rstrip("/") + "/").rpartition("/")
            match = _NAME.fullmatch(name)
            if info.type == fs.FileType.File and source and match and after < match[1] <= until:
                found.setdefault(source, []).append(name)
        return [Split(s, names[i : i + self.files]) for s, names in sorted((s, sorted(n)) for s, n in found.items()) for i in range(0, len(names), self.files)]

    def read(self, split: Split) -> Iterator[tuple]:
        store, root = self._store()
        for name in split.names:
            time, kind = _NAME.fullmatch(name).groups()
            path = f"{root.rstrip('/')}/{split.source}/{name}"
            with store.open_input_stream(path) as stream:
                yield split.source, kind, datetime.strptime(time, _FORM).replace(tzinfo=timezone.utc), path, stream.read().decode("utf-8", "replace")

    def now(self) -> str:
        return (datetime.now(timezone.utc) - timedelta(seconds=self.settle)).strftime(_FORM)


class _Batch(_Pages, DataSourceReader):
    def partitions(self) -> list[Split]:
        return self.landed(_NEVER, self.now()) or [Split("", [])]


class _Stream(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"landed": _NEVER}

    def latestOffset(self) -> dict:
        return {"landed": self.now()}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return self.landed(start["landed"], end["landed"]) or [Split("", [])]

    def commit(self, end: dict) -> None:
        """Nothing to do: pages stay where they landed."""


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(LandedPages)
    return spark

"""Tables that readers see in whole steps: data is staged in folders of its own, and one manifest says which folders count.

A manifest is a small JSON file with a number. A step stages its data, then puts the next manifest beside the others by
one rename that fails where a file is there already; until then readers see the step before, and a step that dies leaves
only staged files, which its repetition writes over. The newest manifest counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardloom.operators.merge import replace_guarded

LEAST = 0.95


class Files:
    """The few file operations of the driver, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.fs.makeQualified(self.hadoop.Path(f"{self.root}/{name}"))

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str, replace: bool) -> None:
        """Writes a file in one step: readers see all of it or what was there. Without ``replace`` an existing file is an error."""
        folder = name.rpartition("/")[0]
        part = f"{folder}/.{uuid.uuid4().hex}.part" if folder else f".{uuid.uuid4().hex}.part"
        stream = self.fs.create(self.path(part), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kind = getattr(self.hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE if replace else kind.NONE
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self.path(part), self.path(name), how)
        except Exception:
            self.fs.delete(self.path(part), False)
            raise


class Manifests:
    """The numbered manifests of a table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def newest(self) -> tuple[int, dict]:
        numbers = [n for n in self.files.names("_manifests") if n.endswith(".json") and not n.startswith(".")]
        return (int(numbers[-1][:-5]), json.loads(self.files.read(f"_manifests/{numbers[-1]}"))) if numbers else (0, {})

    def commit(self, number: int, content: dict) -> None:
        """Makes ``content`` the manifest behind ``number``; fails if another writer was faster."""
        self.files.put(f"_manifests/{number + 1:012d}.json", json.dumps(content, sort_keys=True), replace=False)


def batch_sink(path: str, before_commit: Callable[[int], None] = lambda batch_id: None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each batch's rows once, whenever the query dies.

    A batch is staged under its number, over what an earlier try left, and counts when the manifest names the number.
    A batch that comes again after its commit is passed over. ``before_commit`` is called between the two.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = Manifests(batch.sparkSession, path)
        number, now = table.newest()
        if batch_id <= now.get("batch", -1):
            return
        batch.write.mode("overwrite").parquet(f"{table.path}/batches/batch={batch_id}")
        before_commit(batch_id)
        table.commit(number, {"batch": batch_id})

    return write


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all batches that count, with their ``batch``; staged ones that do not are pruned as partitions."""
    table = Manifests(spark, path)
    last = table.newest()[1].get("batch", -1)
    if last < 0:
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").parquet(f"{table.path}/batches").where(F.col("batch") <= last)


def read_months(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all months that are published."""
    table = Manifests(spark, path)
    folders = sorted(m["folder"] for m in table.newest()[1].get("months", {}).values())
    return spark.read.schema(schema).parquet(*[f"{table.path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def publish_months(rows: DataFrame, path: str, at: str, least: float = LEAST) -> tuple[bool, list]:
    """Replaces the months that ``rows`` has, all in one step, and tells whether all were fit and what became of each.

    A month is refused, and stays as it is, if it would have fewer than ``least`` of its rows; one without a changed row
    keeps its files. Months that ``rows`` lacks stay. A report has ``month, n_old, n_new, replaced, changed`` per month.
    Months are split over tasks by time, so a busy month is written by many.
    """
    spark, table = rows.sparkSession, Manifests(rows.sparkSession, path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    number, now = table.newest()
    version = f"versions/{uuid.uuid4().hex}"
    month = F.substring(F.col(at).cast("string"), 1, 7)
    with_month = lambda df: df.withColumn("__month", month)
    with_month(rows).withColumn("month", F.col("__month")).drop("__month").repartitionByRange("month", at).sortWithinPartitions("month", at).write.partitionBy("month").parquet(f"{table.path}/{version}")
    staged = with_month(spark.read.schema(f"{schema}, month string").parquet(f"{table.path}/{version}").drop("month"))
    # One small row per month comes to the driver.
    found = replace_guarded(with_month(read_months(spark, path, schema)), staged, "__month", least).where("n_new > 0").withColumnRenamed("__month", "month").orderBy("month").collect()
    months = dict(now.get("months", {}))
    months |= {r["month"]: {"folder": f"{version}/month={r['month']}", "rows": r["n_new"]} for r in found if r["replaced"] and (r["changed"] or r["month"] not in months)}
    if months != now.get("months", {}):
        table.commit(number, now | {"months": months})
    return all(r["replaced"] for r in found), found


def drop_months(spark: SparkSession, path: str, before: str) -> list[str]:
    """Takes the months before ``before`` out of the table, in one step."""
    table = Manifests(spark, path)
    number, now = table.newest()
    gone = sorted(m for m in now.get("months", {}) if m < before)
    if gone:
        table.commit(number, now | {"months": {m: v for m, v in now["months"].items() if m >= before}})
    return gone


def put_state(spark: SparkSession, path: str, state: dict) -> None:
    """Replaces a state file in one step."""
    folder, _, name = path.rpartition("/")
    Files(spark, folder).put(name, json.dumps(state, ensure_ascii=False, indent=1), replace=True)

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters of the contracts, as a character list and inside regular expressions.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    A folder of our own is made only where the setting is missing and Spark runs on this machine alone.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="hazardloom-checkpoint-")
        sc.setCheckpointDir(where)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; its lineage ends there, so a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table in the shared folder: smaller than a checkpoint for many rows; it stays there until ``discard``."""
    path = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_few_tasks(df: DataFrame, rows: int, per_task: int = 25_000, least: int = 8) -> DataFrame:
    """``df``, of about ``rows`` rows, read by as many tasks as that needs and not by one for each shuffle partition."""
    return df.coalesce(max(least, -(-rows // per_task)))


def discard(kept: DataFrame) -> None:
    """Deletes the files of a table from ``keep``, when nothing will read it any more."""
    spark = kept.sparkSession
    for name in {f.rpartition("/")[0] for f in kept.inputFiles()[:1]}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files of tables that nothing refers to any more; otherwise they stay until the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Arrow batches of whole texts of at most ``rows`` rows, so that Python workers stay small, unless the session has its own limit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) == 10_000:
        spark.conf.set(name, str(rows))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

"""Results kept in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

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
    """``df`` computed once and kept; its lineage ends there, so a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

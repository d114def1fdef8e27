"""Row files: CSV, JSON lines and poll states, with declared schemas. Every text value arrives as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the row files.
QUAKE_FIELDS = ("event_id", "datetime_pht", "lat", "lon", "depth_km", "mag", "location", "bulletin")
FLOOD_FIELDS = ("date_pht", "sub_basin", "status")
VOLCANO_FIELDS = ("date_pht", "volcano", "alert_level")
HAZARD_FIELDS = ("city_code", "layer", "class_high_pct", "class_medium_pct", "class_low_pct", "label", "source_version", "computed_at")
STATE_SCHEMA = "last_fetch string, last_ok string, last_note string, last_status int, etag string, last_modified string, cooldown_until string"


def csv_rows(spark: SparkSession, path: str, fields: tuple[str, ...]) -> DataFrame:
    """Rows of CSV files with a header, as text, with their place as ``file`` and ``line``; columns that a file lacks are null, others are left out."""
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    have = [F.col(f) if f in raw.columns else F.lit(None).cast("string").alias(f) for f in fields]
    # Rows of a part of a file are numbered in their order, and parts begin further and further behind.
    line = F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))
    return raw.select(*have, F.col("_metadata.file_path").alias("file"), line.alias("line"))


def typed(rows: DataFrame, numbers: tuple[str, ...]) -> DataFrame:
    """Blank text as null, and the given columns as numbers where they are numbers."""
    blank = {c: F.nullif(F.col(c), F.lit("")) for c in rows.columns if c not in ("file", "line")}
    return rows.withColumns(blank).withColumns({c: F.col(c).try_cast("double") for c in numbers})


def last_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys that of the last file in name order, and of the last line in it."""
    cols = [c for c in rows.columns if c not in (*keys, "file", "line")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("file", "line")).alias("r")).select(*keys, "r.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and unreadable lines are left out."""
    rows = spark.read.schema(f"{schema}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)
    return rows.where(F.col("_broken").isNull()).drop("_broken")


def poll_states(spark: SparkSession, path: str) -> DataFrame:
    """``source`` (the file's name) and state of all readable state files that have been polled."""
    rows = spark.read.schema(STATE_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return rows.select(name.alias("source"), "*").where("last_fetch is not null")


def write_months(rows: DataFrame, path: str, at: str) -> None:
    """Rows in folders by month; months that ``rows`` has are replaced, others stay."""
    spark = rows.sparkSession
    month = F.substring(F.col(at).cast("string"), 1, 7)
    rows.withColumn("month", month).repartition("month").sortWithinPartitions(at).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("month").parquet(path)
    spark.catalog.refreshByPath(path)

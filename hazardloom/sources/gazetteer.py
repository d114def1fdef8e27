"""The gazetteer: places by code, read from JSON or made from the star schema, and the names that places go by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardloom.functions.text import name_key
from hazardloom.operators.places import province_keys
from hazardloom.sources.tables import spot, table

SCHEMA = "psgc_code string, name string, geographic_level string, province_code string, region_code string, coordinate struct<latitude: double, longitude: double>"

# The capital region's code; names of regions, as keys, and their codes; other keys of provinces and the
# keys that they stand for; island groups that are written for a province, as keys, and the province.
CAPITAL = "1300000000"
REGIONS = {
    "metromanila": "1300000000", "ncr": "1300000000", "nationalcapitalregion": "1300000000",
    "bicolregion": "0500000000", "ilocosregion": "0100000000", "cagayanvalley": "0200000000",
    "centralluzon": "0300000000", "calabarzon": "0400000000", "mimaropa": "1700000000",
    "westernvisayas": "0600000000", "centralvisayas": "0700000000", "easternvisayas": "0800000000",
    "zamboangapeninsula": "0900000000", "northernmindanao": "1000000000", "davaoregion": "1100000000",
    "soccsksargen": "1200000000", "caraga": "1600000000", "cordilleraadministrativeregion": "1400000000",
    "car": "1400000000", "negrosislandregion": "1800000000", "barmm": "1900000000", "bangsamoro": "1900000000",
}
PROVINCE_ALIASES = {"samar": "westernsamar", "westernsamar": "samar", "compostelavalley": "davaodeoro", "northcotabato": "cotabato", "mtprovince": "mountainprovince"}
ISLANDS = {
    "babuyanislands": "Cagayan", "polilloislands": "Quezon", "calamianislands": "Palawan", "cuyoislands": "Palawan",
    "kalayaanislands": "Palawan", "camotesislands": "Cebu", "bantayanislands": "Cebu", "buriasisland": "Masbate",
    "ticaoisland": "Masbate", "siargaoisland": "Surigao del Norte", "siargaoislands": "Surigao del Norte",
    "bucasgrandeislands": "Surigao del Norte", "caluyaislands": "Antique", "cuyo": "Palawan",
}


def _pairs(spark: SparkSession, values: dict[str, str], schema: str) -> DataFrame:
    return spark.createDataFrame(sorted(values.items()), schema)


def regions(spark: SparkSession) -> DataFrame:
    return _pairs(spark, REGIONS, "key string, code string")


def province_aliases(spark: SparkSession) -> DataFrame:
    return _pairs(spark, PROVINCE_ALIASES, "alias string, key string")


def islands(spark: SparkSession) -> DataFrame:
    return _pairs(spark, ISLANDS, "name string, province string")


def town_aliases(spark: SparkSession, path: str, gazetteer: DataFrame, provinces: DataFrame | None = None) -> DataFrame:
    """``province, written_as, code`` from a JSON array of ``province, written_as, is_in``: names that stand for a town of the province.

    Entries whose province or town the gazetteer does not have are left out; of towns of one key the first code counts.
    """
    provinces = province_keys(gazetteer) if provinces is None else provinces
    raw = spark.read.schema("province string, written_as string, is_in string").option("multiLine", True).json(path)
    named = raw.select(name_key(F.col("province")).alias("p_key"), "written_as", name_key(F.col("is_in")).alias("key"))
    named = named.join(provinces.select(F.col("key").alias("p_key"), F.col("code").alias("province")), "p_key")
    towns = gazetteer.where("level not in ('Prov', 'Reg')").groupBy("province", "key").agg(F.min("code").alias("code"))
    return named.join(towns, ["province", "key"]).select("province", "written_as", "code")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``code, name, level, province, region, lat, lon, key`` of a JSON array of places."""
    raw = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    named = raw.select(F.col("psgc_code").alias("code"), "name", F.col("geographic_level").alias("level"), F.col("province_code").alias("province"), F.col("region_code").alias("region"), F.col("coordinate.latitude").alias("lat"), F.col("coordinate.longitude").alias("lon"))
    return named.withColumn("key", name_key(F.col("name")))


def of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as towns: forty names over all provinces (nations) and regions."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    towns = s.select(F.col("s_suppkey").alias("code"), F.concat(F.lit("Town "), (F.col("s_suppkey") % 40).cast("string")).alias("name"), F.when(F.col("s_suppkey") % 9 == 0, "SubMun").otherwise("City").alias("level"), F.col("s_nationkey").alias("province"), F.col("n_regionkey").alias("region"))
    return spot(towns, "code").withColumn("key", name_key(F.col("name")))


def of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The towns of ``of_suppliers`` and nations as their provinces."""
    n = table(spark, sf_dir, "nation")
    provinces = n.select(F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("name"), F.lit("Prov").alias("level"), F.col("n_nationkey").alias("province"), F.col("n_regionkey").alias("region"))
    return of_suppliers(spark, sf_dir).unionByName(spot(provinces, "code").withColumn("key", name_key(F.col("name"))))

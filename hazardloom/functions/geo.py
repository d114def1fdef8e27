"""Distances, and the range join on a grid."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RADIUS_KM, LAT_KM, LON_KM = 6371.0, 110.57, 111.32
FAR = 1e9
# Sides of the cells that nearest places are looked for in, in km: each twice the one before, the last holds the globe.
SIDES_KM = tuple(float(1 << k) for k in range(15))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres; ``FAR`` where a coordinate is missing."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.coalesce(2 * RADIUS_KM * F.asin(F.sqrt(h)), F.lit(FAR))


def planar2(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared kilometres on the plane that touches at the first point."""
    dx, dy = (lon2 - lon1) * LON_KM * F.cos(F.radians(lat1)), (lat2 - lat1) * LAT_KM
    return dx * dx + dy * dy


def within(places: DataFrame, events: DataFrame, km: float, most_lat: float = 22.0) -> DataFrame:
    """Pairs of places and events at most ``km`` apart, with the columns of both.

    Events keep one grid cell, places are copied to the nine around them, and the two meet in an equi-join; the exact
    distance decides. Cells are as wide as ``km`` is at the latitude ``most_lat``, where degrees are shortest. Both
    have ``lat`` and ``lon``; the events' come out as ``event_lat`` and ``event_lon``.
    """
    height, width = km / LAT_KM * 1.001, km / (LON_KM * math.cos(math.radians(most_lat))) * 1.001
    row, column = F.floor(F.col("lat") / height), F.floor(F.col("lon") / width)
    around = F.explode(F.array(*[F.struct((row + i).alias("row"), (column + j).alias("col")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    left = places.where("lat is not null and lon is not null").withColumn("cell", around)
    right = events.where("lat is not null and lon is not null").withColumn("cell", F.struct(row.alias("row"), column.alias("col"))).withColumnsRenamed({"lat": "event_lat", "lon": "event_lon"})
    close = planar2(F.col("lat"), F.col("lon"), F.col("event_lat"), F.col("event_lon")) <= km * km
    return left.join(right, "cell").where(close).drop("cell")


def _xyz(lat: Column, lon: Column) -> list[Column]:
    """A place in space, in km, from a corner that all places lie above. Chords are shorter than arcs, also across poles and datelines."""
    a, b = F.radians(lat), F.radians(lon)
    return [(c * RADIUS_KM + 7000.0).alias(n) for n, c in (("x", F.cos(a) * F.cos(b)), ("y", F.cos(a) * F.sin(b)), ("z", F.sin(a)))]


def nearest(points: DataFrame, places: DataFrame, on: list[str], km: float | None = None) -> DataFrame:
    """``on, lat, lon, near`` of the distinct ``points`` (``on, lat, lon``): the nearest of the ``places`` (``on, lat, lon, code``) with equal ``on``.

    ``near`` is a struct of ``km, code``, of equal distances the smallest code; with ``km`` only what is nearer than that.
    A place in the smallest cell around the point that has one tells how far to look; cells of about that size hold few
    others, however many places there are. Where coordinates are missing, places are ``FAR``.
    """
    level = F.posexplode(F.array(*[F.lit(s) for s in SIDES_KM])).alias("level", "side")
    cell = lambda c: F.floor(F.col(c) / F.col("side")).cast("int").alias(f"c{c}")
    at = [*on, "level", "cx", "cy", "cz"]
    known = places.groupBy(*on, "lat", "lon").agg(F.min("code").alias("code"))
    spots = known.where("lat is not null and lon is not null").select(*on, "code", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), *_xyz(F.col("lat"), F.col("lon")))
    index = spots.select("*", level).select(*on, "level", *map(cell, "xyz"), "code", "p_lat", "p_lon")
    some = index.groupBy(*at).agg(F.min(F.struct("p_lat", "p_lon")).alias("one"))
    asked = points.select(*on, "lat", "lon").distinct()
    away = haversine(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))
    own = asked.where("lat is not null and lon is not null").select("*", *_xyz(F.col("lat"), F.col("lon"))).select("*", level).select(*on, "lat", "lon", "level", *map(cell, "xyz"))
    bound = own.join(some, at).groupBy(*on, "lat", "lon").agg(F.min_by("one", "level").alias("one"))
    bound = bound.select(*on, "lat", "lon", haversine(F.col("lat"), F.col("lon"), F.col("one.p_lat"), F.col("one.p_lon")).alias("reach"))
    reach = (F.col("reach") if km is None else F.least("reach", F.lit(km))) * (1 + 1e-9) + 1e-3
    # Cells at least twice as wide as it is far: two of them a direction, at most.
    fit = F.least(F.greatest(F.ceil(F.log2(2 * reach)), F.lit(0)), F.lit(len(SIDES_KM) - 1)).cast("int")
    wide = bound.select(*on, "lat", "lon", reach.alias("reach"), fit.alias("level"), *_xyz(F.col("lat"), F.col("lon"))).withColumn("side", F.get(F.array(*[F.lit(s) for s in SIDES_KM]), F.col("level")))
    for c in "xyz":
        wide = wide.withColumn(f"c{c}", F.explode(F.sequence(F.floor((F.col(c) - F.col("reach")) / F.col("side")).cast("int"), F.floor((F.col(c) + F.col("reach")) / F.col("side")).cast("int"))))
    met = wide.select(*at, "lat", "lon").join(index, at).select(*on, "lat", "lon", F.struct(away.alias("km"), "code").alias("near"))
    if km is not None:
        return met.where(F.col("near.km") < km).groupBy(*on, "lat", "lon").agg(F.min("near").alias("near"))
    best = met.groupBy(*on, "lat", "lon").agg(F.min("near").alias("near"))
    first = known.groupBy(*on).agg(F.min(F.struct(F.lit(FAR).alias("km"), "code")).alias("far"))
    best = best.withColumnsRenamed({c: f"b_{c}" for c in (*on, "lat", "lon")})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in (*on, "lat", "lon")])
    return asked.join(best, same, "left").join(first, on).select(*on, "lat", "lon", F.coalesce("near", "far").alias("near"))

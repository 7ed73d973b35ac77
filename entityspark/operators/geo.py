"""Points: bounding box, snapping to place centres, fallbacks, density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions.text import haversine_km, normalize_place

#: The country's box.
BOX = (-4.2, 13.0, -82.0, -67.0)


def in_box(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(*BOX[:2]) & lon.between(*BOX[2:]), F.lit(False))


def snap_to_centres(d: DataFrame, centres: DataFrame, km: float = 100.0) -> DataFrame:
    """lat, lon of points farther than km from their place's centre become the centre. centres: place, lat, lon."""
    c = centres.select(normalize_place(F.col("place"), "upper").alias("__k"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    j = d.withColumn("__k", normalize_place(F.col("place"), "upper")).join(c, "__k", "left")
    far = F.coalesce(haversine_km(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")) > km, F.lit(False))
    return j.withColumns({"snapped": far, "lat": F.when(far, F.col("__lat")).otherwise(F.col("lat")), "lon": F.when(far, F.col("__lon")).otherwise(F.col("lon"))}).drop("__k", "__lat", "__lon")


def with_fallback(d: DataFrame, centres: DataFrame) -> DataFrame:
    """The geocoded point if it lies in the box, else the place's centre; rows with neither go."""
    c = centres.select(normalize_place(F.col("place"), "upper").alias("__k"), F.struct("lat", "lon").alias("__c"))
    j = d.withColumn("__k", normalize_place(F.col("place"), "upper")).join(c, "__k", "left")
    at = F.coalesce(F.when(in_box(F.col("lat"), F.col("lon")), F.struct("lat", "lon")), F.col("__c"))
    return j.withColumn("__at", at).where("__at is not null").withColumns({"lat": F.col("__at.lat"), "lon": F.col("__at.lon")}).drop("__k", "__c", "__at")


def from_cache(d: DataFrame, cache: DataFrame) -> DataFrame:
    """Cached points by code, else by 'address|city|department'. cache: key, lat, lon."""
    c = cache.select("key", F.struct("lat", "lon").alias("at"))
    full = F.concat_ws("|", *(F.lower(F.trim(F.coalesce(x, F.lit("")))) for x in ("address", "place", "department")))
    j = d.withColumn("__f", full).join(c.select(F.col("key").alias("code"), F.col("at").alias("__1")), "code", "left").join(c.select(F.col("key").alias("__f"), F.col("at").alias("__2")), "__f", "left")
    return j.withColumn("__at", F.coalesce("__1", "__2")).withColumns({"lat": F.col("__at.lat"), "lon": F.col("__at.lon")}).drop("__f", "__1", "__2", "__at")


def pending_geocodes(d: DataFrame, cache: DataFrame) -> DataFrame:
    return from_cache(d.drop("lat", "lon"), cache).where("lat is null").agg(F.count("*").alias("pending"))


def density(d: DataFrame, cell: float) -> DataFrame:
    """Points in the box per grid cell."""
    cells = d.where(in_box(F.col("lat"), F.col("lon"))).select(F.floor(F.col("lat") / cell).alias("ci"), F.floor(F.col("lon") / cell).alias("cj"))
    return cells.groupBy("ci", "cj").agg(F.count("*").alias("n"))

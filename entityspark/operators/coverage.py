"""How many listings each requested place has, per source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.functions.text import strip_accents
from entityspark.operators.records import first_per_key


def coverage(requested: DataFrame, listings: dict[str, DataFrame]) -> DataFrame:
    """place, department, one count per source, total. Places are matched by their lower-cased trimmed name, so a name
    of two departments is credited to both. requested: place, department, seq (the last of equal places wins)."""
    key = F.lower(F.trim("place"))
    want = first_per_key(requested, [key, F.lower(F.trim("department"))], [F.desc("seq")]).withColumn("k", key)
    names = list(listings)
    all_ = reduce(lambda a, b: a.unionAll(b), (d.select(F.lower(F.trim("place")).alias("k"), F.lit(s).alias("source")) for s, d in listings.items()))
    counts = all_.join(want.select("k").distinct(), "k", "left_semi").groupBy("k").pivot("source", names).count()
    out = want.join(counts, "k", "left").select("place", "department", *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names))
    return out.withColumn("total", reduce(lambda a, b: a + b, (F.col(n) for n in names)))


def low_coverage(c: DataFrame, threshold: int = 5) -> DataFrame:
    return c.where(F.col("total") < threshold).orderBy("total", "place", "department")


def coverage_summary(c: DataFrame, threshold: int = 5) -> DataFrame:
    return c.agg(F.count("*").alias("places"), F.count_if(F.col("total") < threshold).alias("low"), F.count_if(F.col("total") >= threshold).alias("covered"))


def among(requested: DataFrame, cities: DataFrame) -> DataFrame:
    """Requested places whose normalised name is in a list of cities."""
    norm = lambda c: strip_accents(F.lower(F.trim(c)))
    return requested.withColumn("__k", norm("place")).join(cities.select(norm("city").alias("__k")).distinct(), "__k", "left_semi").drop("__k")


def work_list(keywords: DataFrame, places: DataFrame, done: DataFrame) -> DataFrame:
    """Every keyword with every place (two request lists; what is crossed is the answer), without queries already done."""
    q = keywords.crossJoin(places).select("keyword", "place", F.concat(F.col("keyword"), F.lit(" en "), F.initcap("place"), F.lit(", Colombia")).alias("query"), F.lit(1).alias("page"))
    return q.join(done.select("query", "page"), ["query", "page"], "left_anti")

"""From source listings to one normalised record table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityspark.functions import text as X

#: Source names in the order of their ids, and words of an inactive register entry.
SOURCES = ["google_maps", "paginas_amarillas", "foursquare", "openstreetmap", "rues", "serper"]
INACTIVE = ["cancelada", "cancelado", "inactiva", "inactivo", "suspendida", "suspendido", "no renovada", "no renovado"]
UNAPPROVED = ["cancelada", "cancelado", "inactiva", "inactivo", "suspendida"]


def record_id(source: str, raw_id: Column) -> Column:
    """A total order over all records without a shuffle."""
    return F.lit(SOURCES.index(source) << 40) + raw_id.cast("long")


def unify_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """The union of source frames by column name, with source, raw_id and record_id; rows without a name go, columns a
    source lacks are null."""
    parts = [d.where("name is not null").withColumns({"source": F.lit(s), "raw_id": F.col("id").cast("long"), "record_id": record_id(s, F.col("id"))}).drop("id") for s, d in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def in_places(d: DataFrame, column: str, places: list[str]) -> DataFrame:
    """Rows whose place is in the list; all rows for an empty list."""
    return d.where(X.normalize_address_bulk(F.col(column)).isin(places)) if places else d


def register_in_places(d: DataFrame, places: list[str], place: str = "place", chamber: str = "chamber") -> DataFrame:
    return d.where(X.chamber_to_city(F.col(place)).isin(places) | X.chamber_to_city(F.col(chamber)).isin(places)) if places else d


def first_per_key(d: DataFrame, key: list[Column | str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order; end the order with an id to settle ties."""
    w = Window.partitionBy(*key).orderBy(*order)
    return d.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def register_dedup(d: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """One register entry per tax number (or id): active first, then the higher score, then the id."""
    d = d.where(F.col("name").isNotNull() | F.col("legal_name").isNotNull())
    if keywords:
        d = d.where(F.col("keyword").isin(keywords))
    active = F.coalesce(F.lower("status").contains("activ") & ~F.lower("status").contains("inactiv"), F.lit(False))
    return first_per_key(d, [F.coalesce("nit", F.col("id").cast("string"))], [F.desc(active), F.desc_nulls_last("score"), F.asc("id")])


def inactive_penalty(d: DataFrame) -> DataFrame:
    status = F.lower(F.coalesce("status", F.lit("")))
    base = F.coalesce("score", F.lit(50))
    return d.withColumns({"score": F.when(status.isin(INACTIVE), F.greatest(F.lit(0), base - 15)).otherwise(base),
                          "approved": F.when(status.isin(UNAPPROVED), F.lit(False)).otherwise(F.col("approved"))})


def prefer(*columns: str) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*(F.when(F.trim(c) != "", F.col(c)) for c in columns))


def drop_in_liquidation(d: DataFrame, name: str = "name", legal: str = "legal_name", active: bool = True) -> DataFrame:
    hit = [F.coalesce(F.col(c).rlike(r"(?i)en\s+liquidaci[oóOÓ]n"), F.lit(False)) for c in (name, legal) if c in d.columns]
    return d.where(~reduce(lambda a, b: a | b, hit)) if active and hit else d


def normalize_records(d: DataFrame, phone_mode: str = "bulk") -> DataFrame:
    """Adds the normalised columns and match keys to records; phone_mode 'prefix' takes only the leading country code."""
    legal = F.col("legal_name") if "legal_name" in d.columns else F.lit(None).cast("string")
    d = d.withColumns({"name_norm": X.normalize_name_bulk(F.col("name"), legal), "place_norm": X.normalize_address_bulk(F.col("place")),
                       "phone_norm": X.normalize_phone_bulk(F.col("phone")) if phone_mode == "bulk" else X.normalize_phone(F.col("phone")),
                       "email_norm": X.normalize_email(F.col("email")), "address_norm": X.normalize_address_bulk(F.col("address"))})
    return d.withColumns(X.match_keys(F.col("nit"), F.col("email_norm"), F.col("phone_norm"), F.col("name_norm"), F.col("place_norm")))


def standardize_places(d: DataFrame, places: DataFrame) -> DataFrame:
    """Place code and standard names by normalised place; a name of several departments goes to the row's own
    department if that is one of them, else to the smallest code. places: code, place_norm, department_norm, at most
    the few thousand places of a country."""
    d = d.withColumn("__p", X.normalize_address_bulk(F.col("place"))).withColumn("__d", X.normalize_address_bulk(F.col("department")) if "department" in d.columns else F.lit(None).cast("string"))
    p = places.groupBy("place_norm").agg(F.sort_array(F.collect_list(F.struct("code", "department_norm"))).alias("__all"))
    d = d.drop("place_norm", "department_norm", "place_code").join(p, F.col("__p") == F.col("place_norm"), "left")
    own = F.try_element_at(F.filter("__all", lambda x: x["department_norm"] == F.col("__d")), F.lit(1))
    best = F.coalesce(own, F.try_element_at("__all", F.lit(1)))
    return (d.withColumns({"place_code": best["code"], "department_norm": F.coalesce(best["department_norm"], F.col("__d")), "place_norm": F.coalesce("place_norm", "__p")})
            .drop("__all", "__p", "__d"))

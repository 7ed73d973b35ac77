"""One best record per cluster, by per-field source priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.operators.components import connected_components
from entityspark.operators.records import first_per_key

# For every field of the best record its source column and the sources to prefer, in order.
PRIORITY = {
    "nit": ("nit", ["rues", "google_maps", "paginas_amarillas", "serper"]), "dv": ("dv", ["rues"]), "register_id": ("register_id", ["rues"]), "registration": ("registration", ["rues"]),
    "legal_name": ("legal_name", ["rues", "serper", "google_maps"]), "name": ("name", ["google_maps", "paginas_amarillas", "foursquare", "serper", "rues"]),
    "name_norm": ("name_norm", ["google_maps", "paginas_amarillas", "foursquare", "serper", "rues"]), "department": ("department_norm", ["rues", "google_maps", "paginas_amarillas", "openstreetmap"]),
    "place": ("place_norm", ["rues", "google_maps", "paginas_amarillas", "openstreetmap"]), "place_code": ("place_code", ["rues"]),
    "address": ("address", ["google_maps", "rues", "paginas_amarillas", "openstreetmap"]), "address_norm": ("address_norm", ["google_maps", "rues", "paginas_amarillas", "openstreetmap"]),
    "lat": ("lat", ["google_maps", "foursquare", "openstreetmap", "serper"]), "lon": ("lon", ["google_maps", "foursquare", "openstreetmap", "serper"]),
    "phone": ("phone_norm", ["rues", "google_maps", "paginas_amarillas", "serper", "foursquare"]), "whatsapp": ("whatsapp_norm", ["google_maps", "paginas_amarillas", "serper"]),
    "email": ("email_norm", ["rues", "serper", "paginas_amarillas", "openstreetmap", "google_maps"]), "website": ("website", ["google_maps", "paginas_amarillas", "foursquare", "serper"]),
    "code": ("code", ["rues"]), "code_name": ("code_name", ["rues"])}
BLANK_IS_NULL = ["nit", "dv", "register_id", "registration"]
SOURCE_ORDER = ["rues", "google_maps", "paginas_amarillas", "foursquare", "serper", "openstreetmap"]
PHONE_CONFIDENCE = {"rues": 95, "google_maps": 85, "paginas_amarillas": 80}
EMAIL_CONFIDENCE = {"rues": 95, "serper": 85, "paginas_amarillas": 80}
ADDRESS_CONFIDENCE = {"rues": 90, "google_maps": 85}


def cluster_records(records: DataFrame, matches: DataFrame) -> DataFrame:
    """records with entity: the smallest record_id reachable over confirmed matches; a record without any is its own."""
    edges = matches.where("decision in ('auto_match', 'ia_match')").select("a", "b")
    found = connected_components(edges).select(F.col("node").alias("record_id"), F.col("component").alias("entity"))
    return records.join(found, "record_id", "left").withColumn("entity", F.coalesce("entity", "record_id"))


def source_rank(c: Column) -> Column:
    place = F.array_position(F.array(*(F.lit(s) for s in SOURCE_ORDER)), c)
    return F.when(place > 0, place).otherwise(len(SOURCE_ORDER) + 1)


def merge_golden(clustered: DataFrame, priority: dict | None = None, paired_coordinates: bool = False) -> DataFrame:
    """One aggregation: per field the largest value of the first preferred source that has one, else of all.

    Fields whose column is missing are left out. paired_coordinates takes lat and lon from one record.
    """
    def pick(column: Column, sources: list[str]) -> Column:
        return F.coalesce(*(F.max(F.when(F.col("source") == s, column)) for s in sources), F.max(column))

    aggs = []
    for field, (column, sources) in (priority or PRIORITY).items():
        if column not in clustered.columns or paired_coordinates and field in ("lat", "lon"):
            continue
        value = pick(F.col(column), sources)
        aggs.append((F.nullif(value, F.lit("")) if field in BLANK_IS_NULL else value).alias(field))
    if paired_coordinates:
        aggs.append(pick(F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon")), PRIORITY["lat"][1]).alias("__at"))
    out = clustered.groupBy("entity").agg(*aggs, F.min_by("source", F.struct(source_rank(F.col("source")), "record_id")).alias("main_source"))
    return out.withColumns({"lat": F.col("__at.lat"), "lon": F.col("__at.lon")}).drop("__at") if paired_coordinates else out


def main_source(clustered: DataFrame) -> DataFrame:
    best = F.min_by(F.struct("source", "score", "approved"), F.struct(source_rank(F.col("source")), "record_id"))
    return clustered.groupBy("entity").agg(best.alias("m")).select("entity", "m.*")


def entity_stats(clustered: DataFrame, matches: DataFrame, time_col: str | None = None) -> DataFrame:
    """Sources, their number, first and last extraction and the matches that touch an entity; each match is sent to
    both its records, which turns the either-side condition into an equality."""
    ends = matches.select(F.explode(F.array("a", "b")).alias("record_id"), F.struct("a", "b").alias("m"))
    touch = ends.join(clustered.select("record_id", "entity"), "record_id").select("entity", "m").distinct().groupBy("entity").agg(F.count("*").alias("n_matches"))
    return entity_sources(clustered, time_col).join(touch, "entity", "left").na.fill(0, ["n_matches"])


def entity_sources(clustered: DataFrame, time_col: str | None = None) -> DataFrame:
    times = [F.min(time_col).alias("first_seen"), F.max(time_col).alias("last_seen")] if time_col else []
    return clustered.groupBy("entity").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count_distinct("source").alias("n_sources"), *times)


def unique_on(entities: DataFrame, keys: tuple[str, ...] = ("nit", "register_id")) -> DataFrame:
    """Entities in order of entity; a later one with the nit or register id of an earlier one goes."""
    for key in keys:
        if key in entities.columns:
            have = first_per_key(entities.where(F.col(key).isNotNull()), [key], [F.asc("entity")])
            entities = have.unionByName(entities.where(F.col(key).isNull()))
    return entities


def _confidence(table: dict[str, int]) -> Column:
    c = F.lit(70)
    for source, value in table.items():
        c = F.when(F.col("source") == source, value).otherwise(c)
    return c


def contact_tables(clustered: DataFrame, entities: DataFrame) -> dict[str, DataFrame]:
    """phones, emails, addresses and sources of the entities given."""
    from entityspark.functions.text import contact_phone_type

    d = clustered.join(entities.select("entity", F.col("phone").alias("__phone"), F.col("email").alias("__email")), "entity")
    phones = d.where("phone_norm is not null").select("entity", F.col("phone_norm").alias("phone"), contact_phone_type(F.col("phone_norm")).alias("type"), "source",
                                                      F.col("phone_norm").eqNullSafe(F.col("__phone")).alias("is_main"), _confidence(PHONE_CONFIDENCE).alias("confidence")).distinct()
    emails = d.where("email_norm is not null").select("entity", F.col("email_norm").alias("email"), "source", F.col("email_norm").eqNullSafe(F.col("__email")).alias("is_main"),
                                                      _confidence(EMAIL_CONFIDENCE).alias("confidence")).distinct()
    addresses = d.where("address is not null").withColumn("confidence", _confidence(ADDRESS_CONFIDENCE))
    addresses = first_per_key(addresses, ["entity", "address"], [F.desc("confidence"), F.asc("record_id")]).select("entity", "address", "source", "confidence")
    return {"phones": phones, "emails": emails, "addresses": addresses, "sources": d.select("entity", "source", "record_id")}


def merge_report(entities: DataFrame) -> DataFrame:
    return entities.groupBy(F.coalesce("n_sources", F.lit(1)).alias("n_sources")).agg(F.count("*").alias("n_entities"))


def source_contribution(clustered: DataFrame, multi: DataFrame, fields: list[str]) -> DataFrame:
    """Per source the non-null values it gives to entities of several sources."""
    return clustered.join(multi.select("entity"), "entity", "left_semi").groupBy("source").agg(*(F.count(f).alias(f) for f in fields))


def field_provenance(clustered: DataFrame, entities: DataFrame, fields: dict[str, str]) -> DataFrame:
    """entity, field, value, source: the first source, by priority, whose value equals the entity's. fields: the
    entity's column to the record's."""
    def long(d: DataFrame, names: dict[str, str], extra: list[str]) -> DataFrame:
        return d.select("entity", *extra, F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.col(v).cast("string").alias("value")) for k, v in names.items()))).alias("x")).select("entity", *extra, "x.*")

    golden = long(entities, {k: k for k in fields}, []).where("value is not null")
    rows = long(clustered, fields, ["source", "record_id"])
    return rows.join(golden, ["entity", "field", "value"]).groupBy("entity", "field", "value").agg(F.min_by("source", F.struct(source_rank(F.col("source")), "record_id")).alias("source"))

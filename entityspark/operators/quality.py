"""Field conflicts, validity and quality scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.operators.matching import EXACT_RULES, exact_pairs_per_entity

#: Severity per field, and weights of the two scores.
SEVERITY = {"name": "media", "phone": "media", "email": "baja", "place": "alta"}
WEIGHTS = {"nit": 25, "name": 15, "place": 10, "address": 10, "phone": 15, "email": 10}
SOURCE_WEIGHT = {"google_maps": 25, "paginas_amarillas": 20, "foursquare": 15, "serper": 15, "openstreetmap": 10}


def _keyed(d: DataFrame, key: str, blank_is_value: bool) -> DataFrame:
    k = F.col(key) if blank_is_value else F.when(F.trim(key) != "", F.col(key))
    return d.withColumn("__k", k).where("__k is not null")


def conflict_classes(d: DataFrame, fields: dict[str, str], key: str = "nit", blank_is_value: bool = False) -> DataFrame:
    """key, field, severity, n_values, values, sources, n_records: one row for each key and field with several distinct
    values. fields: field name to column. All fields go through one aggregation by key; blank keys are null unless
    asked otherwise, so they make no giant group. Linear in the records, however many share a key."""
    d = _keyed(d, key, blank_is_value)
    entries = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("value"), "source") for f, c in fields.items())))
    # how often a value stands there sums up before the shuffle; nulls count as records, not as values
    counted = d.select("__k", entries.alias("x")).groupBy("__k", "x.field", "x.value", "x.source").agg(F.count("*").alias("n"))
    known = F.col("value").isNotNull()
    groups = counted.groupBy("__k", "field").agg(F.count_distinct("value").alias("n_values"), F.array_sort(F.collect_set("value")).alias("values"), F.array_sort(F.collect_set(F.when(known, F.col("source")))).alias("sources"), F.sum("n").alias("n_records"))
    severity = F.lit("media")
    for f, s in SEVERITY.items():
        severity = F.when(F.col("field") == f, s).otherwise(severity)
    return groups.where("n_values > 1").select(F.col("__k").alias(key), "field", severity.alias("severity"), F.col("n_values").cast("long").alias("n_values"), "values", "sources", "n_records")


def detect_conflicts(d: DataFrame, fields: dict[str, str], key: str = "nit", blank_is_value: bool = False) -> DataFrame:
    """record_id, key, field, severity, n_values, values, sources: the classes of conflict_classes() on each of their
    records, for reports by record. Every record of a key repeats its arrays; counts and listings by key do without."""
    classes = conflict_classes(d, fields, key, blank_is_value)
    return _keyed(d, key, blank_is_value).select("record_id", F.col("__k").alias(key)).join(classes, key).select("record_id", key, "field", "severity", "n_values", "values", "sources")


def invalid_formats(d: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Records whose original field is not blank but whose normal form is null. fields: name to (original, normal)."""
    entries = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(o).alias("value"), F.col(n).alias("__n")) for f, (o, n) in fields.items())))
    return d.select("record_id", F.array("source").alias("sources"), entries.alias("x")).where("trim(x.value) != '' and x.`__n` is null").select("record_id", "x.field", "x.value", "sources")


def conflict_summary(conflicts: DataFrame) -> DataFrame:
    """Counts by field, by severity and in total of conflicts by record or, weighted by n_records, of their classes; the
    total is there for an empty table too."""
    none, n = F.lit(None).cast("string"), F.coalesce(F.sum("n_records"), F.lit(0)) if "n_records" in conflicts.columns else F.count("*")
    by = conflicts.groupingSets([[F.col("field")], [F.col("severity")]], "field", "severity").agg(n.alias("n"), F.grouping_id().alias("level"))
    total = conflicts.agg(n.alias("n")).select(none.alias("field"), none.alias("severity"), "n", F.lit(3).alias("level"))
    return by.select("field", "severity", "n", F.col("level").cast("int").alias("level")).unionAll(total)


def severity_rank(c: Column) -> Column:
    return F.when(c == "critica", 1).when(c == "alta", 2).when(c == "media", 3).otherwise(4)


def quality_score(e: DataFrame) -> DataFrame:
    """Adds quality (0 to 130) and approved (80 or more) to entities with sources."""
    score = F.lit(0)
    for column, weight in WEIGHTS.items():
        score = score + F.when(F.col(column).isNotNull(), weight).otherwise(0)
    score = score + F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), 10).otherwise(0)
    score = score + F.when(F.array_contains("sources", "rues"), 20).otherwise(0) + F.when(F.size("sources") >= 2, 15).otherwise(0)
    return e.withColumn("quality", score).withColumn("approved", F.col("quality") >= 80)


def matches_per_entity(clustered: DataFrame, matches: DataFrame, stars: bool = False) -> DataFrame:
    """Confirmed pairs by the entity of their first record. stars: the exact rules' matches are stars, so their pairs
    are counted by the sizes of the groups with equal keys; reviewed matches are counted as they stand."""
    m, exact = matches.where("decision in ('auto_match', 'ia_match')").withColumn("n", F.lit(1)), F.col("rule").isin([r[0] for r in EXACT_RULES])
    if stars:  # the counted pairs that a review has taken out, and those that only a review has confirmed
        m = matches.where((F.col("decision") == "no_match") & exact).withColumn("n", F.lit(-1)).unionByName(m.where((F.col("decision") == "ia_match") & ~exact))
    n = m.join(clustered.select(F.col("record_id").alias("a"), "entity"), "a").groupBy("entity").agg(F.sum("n").alias("n"))
    if stars:
        n = n.unionByName(exact_pairs_per_entity(clustered)).groupBy("entity").agg(F.sum("n").alias("n"))
    return clustered.select("entity").distinct().join(n.withColumnRenamed("n", "n_matches"), "entity", "left").na.fill(0, ["n_matches"])


def quality_summary(e: DataFrame) -> DataFrame:
    q = F.col("quality")
    return e.agg(F.count("*").alias("total"), F.count_if("approved").alias("approved"), F.count_if(q.between(60, 79)).alias("middle"), F.count_if(q < 60).alias("low"),
                 F.round(F.avg(q), 1).alias("average"), F.min(q).alias("least"), F.max(q).alias("most"))


def score_histogram(e: DataFrame, edges: tuple[int, ...] = (0, 20, 40, 60, 80)) -> DataFrame:
    bounds = [*edges, None]
    q = F.col("quality")
    return e.agg(*(F.count_if((q >= lo) & (q < hi if hi is not None else F.lit(True))).alias(f"from_{lo}") for lo, hi in zip(bounds[:-1], bounds[1:])))


def validity_score(d: DataFrame, facts: DataFrame | None = None, reviews: DataFrame | None = None) -> DataFrame:
    """Adds validity and valid. facts: record_id, nit, phone from search results; reviews: record_id, positive,
    confidence; a positive review counts between 30 and 65. Records at 80 or more pass without facts."""
    weight = F.lit(10)
    for s, w in SOURCE_WEIGHT.items():
        weight = F.when(F.col("source") == s, w).otherwise(weight)
    has = lambda c, w: F.when(F.trim(c) != "", w).otherwise(0)
    base = has("phone_norm", 20) + has("email_norm", 15) + has("key_nit", 30) + weight
    d = d.withColumn("validity", base)
    if facts is not None:
        f = facts.select("record_id", F.lit(20).alias("__f"), F.when(F.col("nit").isNotNull(), 20).otherwise(0).alias("__n"), F.when(F.col("phone").isNotNull(), 10).otherwise(0).alias("__p"))
        d = d.join(f, "record_id", "left").withColumn("validity", F.col("validity") + F.when(F.col("validity") < 80, F.coalesce(F.expr("__f + __n + __p"), F.lit(0))).otherwise(0)).drop("__f", "__n", "__p")
    if reviews is not None:
        r = reviews.where("positive").select("record_id", F.col("confidence").alias("__c"))
        bonus = F.when(F.col("validity").between(30, 65), F.coalesce(F.floor(20 * F.col("__c")).cast("int"), F.lit(0))).otherwise(0)
        d = d.join(r, "record_id", "left").withColumn("validity", F.col("validity") + bonus).drop("__c")
    return d.withColumn("validity", F.least(F.lit(100), F.col("validity"))).withColumn("valid", F.col("validity") >= 40)


def validation_candidates(d: DataFrame, n: int) -> DataFrame:
    return d.where("source != 'rues' and nit is null and name is not null and approved").orderBy("source", "record_id").limit(n)


def backfill(d: DataFrame, found: DataFrame) -> DataFrame:
    """found: record_id, score, valid, nit, phone, email. Score rises only, contacts are filled only where null."""
    f = found.select("record_id", *(F.col(c).alias(f"__{c}") for c in ("score", "valid", "nit", "phone", "email")))
    j = d.join(f, "record_id", "left")
    fill = {c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in ("nit", "phone", "email") if c in d.columns}
    return j.withColumns({"score": F.greatest("score", "__score"), "approved": F.coalesce("__valid", "approved")} | fill).select(*d.columns)


def register_status_points(status: Column, renewed: Column, as_of_year: int) -> Column:
    """Points for a register entry's status and last renewal (its first four characters are the year)."""
    from entityspark.operators.records import INACTIVE

    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    age = as_of_year - F.substring(renewed, 1, 4).try_cast("int")
    return F.when(s.isin(INACTIVE), -15).when(s == "", -5).when(age >= 4, -10).when(age >= 2, -5).otherwise(0)


def drop_inactive_register_only(e: DataFrame) -> DataFrame:
    only = F.coalesce(F.col("sources") == F.array(F.lit("rues")), F.lit(False))
    return e.where(~(~F.coalesce("approved", F.lit(False)) & only))

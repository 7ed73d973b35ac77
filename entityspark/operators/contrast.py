"""Entities against a customer list: best fuzzy candidate within a place, and what is left over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.functions.ratios import partial, ratio, sorted_tokens
from entityspark.functions.text import normalize_address_upper, normalize_name_upper, normalize_place
from entityspark.operators.best import best_candidates, common_letters, sliced_join, with_letter_bits
from entityspark.operators.records import first_per_key
from entityspark.storage import materialize


def read_customers(spark, path: str, names: dict[str, list[str]] | None = None) -> DataFrame:
    """A customer sheet saved as CSV: all strings, trimmed headers, the first present of alternative column names,
    missing columns empty. seq orders the rows as the files have them: by name, then block, then row of the block."""
    d = spark.read.csv(path, header=True, inferSchema=False)
    have = {c.strip(): c for c in d.columns}
    pick = lambda options: F.coalesce(*(F.col(f"`{have[o]}`") for o in options if o in have), F.lit(""))
    names = names or {"code": ["Código de cliente"], "account": ["Nombre de la cuenta"], "address": ["Dirección"], "place": ["Población: Población", "Población"],
                      "department": ["Departamento (Texto)", "Departamento"], "mobile": ["Móvil"]}
    return d.select(*(pick(o).alias(n) for n, o in names.items()), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("seq"))


def dedup_customers(c: DataFrame) -> DataFrame:
    return first_per_key(c, ["code"], [F.asc("seq")])


#: Names of either side that meet in one task's key at most, about.
SLICE = 500


def best_match(prospects: DataFrame, customers: DataFrame, sure: float = 85, maybe: float = 70, address: float = 60) -> DataFrame:
    """prospect_id, code, account, score, category: per prospect the customer of its place with the best token-sort
    ratio (the first in seq on ties): confirmed from sure on, probable from maybe on if the addresses agree too. Rows
    without a name match nothing; addresses agree only where both sides have one.

    Names that are equal but for the order of their tokens have equal ratios: of a place they meet once, customers as
    the first in seq. Equal strings are settled by a plain join. For the rest, a ratio is at most 200 * common
    characters / (both lengths), which bitmaps of letter counts give; the candidate of the highest
    bound is scored first, then only those whose bound reaches that score.
    """
    p = prospects.select("prospect_id", normalize_name_upper(F.col("name")).alias("pn"), normalize_address_upper(F.col("address")).alias("pa"), normalize_place(F.col("place"), "upper").alias("k"))
    c = customers.select("code", "account", "seq", normalize_name_upper(F.col("account")).alias("cn"), normalize_address_upper(F.col("address")).alias("ca"), normalize_place(F.col("place"), "upper").alias("k"))
    p, c = (d.withColumn("s", sorted_tokens(F.col(n))).where("s != ''") for d, n in ((p, "pn"), (c, "cn")))
    names = materialize(with_letter_bits(c.groupBy("k", "s").agg(F.min_by(F.struct("code", "account", "ca", "seq"), "seq").alias("customer")), "s"))
    slim = names.withColumn("seq", F.col("customer.seq")).drop("customer")
    mine = p.select("k", "s").distinct()
    equal = mine.join(names.select("k", "s", "customer"), ["k", "s"]).select("k", "s", "customer", F.lit(100.0).alias("score"))
    rest = materialize(with_letter_bits(mine.join(names.select("k", "s"), ["k", "s"], "left_anti"), "s"))
    bound = common_letters() * 200.0 / (F.length("x.s") + F.length("y.s"))
    found = best_candidates(rest, lambda rows: sliced_join(rows, slim, SLICE), ["k", "s"], {"seq": F.col("y.seq"), "s": F.col("y.s")}, bound, lambda t: ratio(t["s"], t["c"]["s"]), "seq", maybe)
    found = found.select("k", "s", F.col("candidate.s").alias("t"), "score").join(names.select("k", F.col("s").alias("t"), "customer"), ["k", "t"])
    j = equal.unionAll(found.select("k", "s", "customer", "score")).select("k", "s", "customer.*", "score")
    j = p.select("prospect_id", "pa", "k", "s").join(j, ["k", "s"])
    best = j.groupBy("prospect_id").agg(F.min_by(F.struct("code", "account", "score", "pa", "ca"), F.struct(-F.col("score"), "seq")).alias("m")).select("prospect_id", "m.*")
    near = F.when((F.col("pa") != "") & (F.col("ca") != "") & (F.col("score") < sure), partial(F.col("pa"), F.col("ca")) >= address)
    category = F.when(F.col("score") >= sure, "confirmed").when(near, "probable").otherwise("new")
    best = best.withColumn("category", category)
    hit = F.col("category") != "new"
    best = best.select("prospect_id", *(F.when(hit, F.col(c)).alias(c) for c in ("code", "account")), F.col("score"), "category")
    return prospects.select("prospect_id").join(best, "prospect_id", "left").withColumn("category", F.coalesce("category", F.lit("new")))


def unmatched_customers(customers: DataFrame, matched: DataFrame) -> DataFrame:
    """Customers whose account name, in upper case, no prospect has."""
    return customers.join(matched.where("account is not null").select(F.upper("account").alias("__k")).distinct(), F.upper("account") == F.col("__k"), "left_anti")


def kpis(categories: DataFrame) -> DataFrame:
    n = F.count("*")
    known = F.count_if(F.col("category").isin("confirmed", "probable"))
    return categories.agg(n.alias("total"), *(F.count_if(F.col("category") == c).alias(c) for c in ("confirmed", "probable", "new")), F.round(F.when(n > 0, known * 100.0 / n).otherwise(0.0), 1).alias("coverage"))


def prospects_in(d: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose place is asked for, in the asked department where the request and the row name one. pairs: place,
    department, a request list."""
    ask = pairs.select(normalize_place(F.col("place"), "upper").alias("__p"), normalize_place(F.col("department"), "upper").alias("__d"))
    dept = normalize_place(F.coalesce("department", F.lit("")), "upper")
    same = (normalize_place(F.col("place"), "upper") == F.col("__p")) & ((F.col("__d") == "") | ((dept != "") & (dept == F.col("__d"))))
    return d.join(ask, same, "left_semi")


def dashboard_rows(d: DataFrame, low: int, high: int, approved: bool | None = None, categories: list[str] | None = None) -> DataFrame:
    d = d.where(F.coalesce("quality", F.lit(0)).between(low, high))
    if approved is not None:
        d = d.where(F.coalesce("approved", F.lit(False)) == approved)
    return d.where(F.col("category").isin(categories)) if categories else d

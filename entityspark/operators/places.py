"""Free text and fuzzy names to known places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions.ratios import slug_ratio
from entityspark.functions.text import normalize_place
from entityspark.operators.best import best_candidates, common_letters, sliced_join, with_letter_bits
from entityspark.operators.records import first_per_key
from entityspark.storage import materialize

ACCEPT, SUGGEST = 88.0, 72.0
#: Filling words that are never a place by themselves.
STOP_WORDS = ["es", "la", "de", "y", "un", "una", "los", "las", "el", "en", "a", "o", "u", "por", "para", "con", "sin", "del", "al", "son",
              "está", "están", "soy", "eres", "somos", "que", "si", "no", "más", "menos", "muy", "mejor", "peor", "bien", "mal", "bueno", "malo",
              "grande", "pequeño", "nuevo", "viejo", "joven", "mayor", "menor", "ciudad", "municipio", "departamento", "región", "zona", "área",
              "desde", "hasta", "entre", "dentro", "fuera", "sobre", "bajo", "me", "te", "se", "les", "mis", "tus", "sus"]


def index_keys(s: Column, query: bool) -> Column:
    """Keys of a slug such that any two with a weighted ratio of SUGGEST or more share one.

    Of m letters in common order and D other ones, m - 1 - D pairs of neighbours are kept. At a ratio of 72 that is one
    or more from m = 5 on; below, both slugs have at most seven letters and share a pair in order with any gap. A
    partial ratio of 80 keeps a pair of neighbours too unless one slug has at most three letters: such a slug meets
    all that share a letter, under keys of two kinds, so that longer ones do not meet each other on them.
    """
    n = F.length(s)
    at = lambda i, size=1: F.substring(s, i, F.lit(size))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: at(i, 2)))
    gaps = F.when((n > 1) & (n <= 7), F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(F.sequence(i + 1, n), lambda j: F.concat(at(i), at(j))))))
    single = F.filter(F.split(s, ""), lambda c: c != "")
    short, any_ = ("short ", "any ") if query else ("any ", "short ")
    mine = F.when(n <= 3, F.transform(single, lambda c: F.concat(F.lit(short), c)))
    theirs = F.transform(single, lambda c: F.concat(F.lit(any_), c))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*(F.coalesce(x, none) for x in (pairs, gaps, mine, theirs))))


def _scored(queries: DataFrame, known: DataFrame, by_department: bool) -> DataFrame:
    """q, d, slug, score: the best known slug of each distinct query, the first in order on ties, where its ratio is at
    least SUGGEST. Queries and places meet by an inverted index of letter pairs; keys that many share are sliced on both
    sides, and a pair counts under the first key that it shares."""
    def indexed(d: DataFrame, query: bool) -> DataFrame:
        return materialize(with_letter_bits(d, "s").withColumn("keys", index_keys(F.col("s"), query)).withColumn("k", F.explode("keys")))

    asked = queries.select(F.col("q").alias("s"), "d").distinct()
    places = known.select(F.col("slug").alias("s"), *(["department"] if by_department else [])).distinct()
    index = indexed(places.where("s != ''"), False)
    la, lb, m = F.length("x.s"), F.length("y.s"), common_letters()
    n = F.least(la, lb)
    share = F.greatest(la, lb) / n
    plain, part = 200.0 * m / (la + lb), 0.9 * (200.0 * F.least(m, n) / (n + F.least(m, n)))
    bound = F.when((share < 1.5) | (share > 8), plain).otherwise(F.greatest(plain, part))

    def meet(rows: DataFrame) -> DataFrame:
        pairs = sliced_join(rows, index).where(F.array_intersect("x.keys", "y.keys")[0] == F.col("x.k"))
        return pairs.where(F.col("x.d").isNull() | (F.col("x.d") == F.col("y.department"))) if by_department else pairs

    keyed = indexed(asked, True).withColumn("d_", F.coalesce("d", F.lit("")))
    found = best_candidates(keyed, meet, ["s", "d_"], {"slug": F.col("y.s")}, bound, lambda t: slug_ratio(t["s"], t["c"]["slug"]), "slug", SUGGEST)
    return found.select(F.col("s").alias("q"), F.nullif("d_", F.lit("")).alias("d"), "candidate.slug", "score")


def resolve_places(requests: DataFrame, known: DataFrame, by_department: bool = False) -> DataFrame:
    """requests (id, place[, department]) with slug, score, how: exact slug 100; else the best ratio: fuzzy_high from
    88, fuzzy_medium (a suggestion) from 72, else rejected with score 0. Only distinct strings without an exact slug are
    scored. Neither requests nor places have a bound on their number."""
    r = requests.withColumn("q", normalize_place(F.col("place"), "slug")).withColumn("d", normalize_place(F.col("department"), "slug") if by_department else F.lit(None).cast("string"))
    k = known.withColumn("department", normalize_place(F.col("department"), "slug"))
    same = (F.col("q") == F.col("__s")) & (F.col("d").isNull() | (F.col("d") == F.col("__dd")) if by_department else F.lit(True))
    exact = r.join(k.select(F.col("slug").alias("__s"), F.col("department").alias("__dd")), same, "left_semi").select("id", F.col("q").alias("slug"), F.lit(100.0).alias("score"), F.lit("exact").alias("how"))
    left = r.join(exact.select("id"), "id", "left_anti").where("q != ''")
    scored = _scored(left, k, by_department)
    how = F.when(F.col("score") >= ACCEPT, "fuzzy_high").otherwise("fuzzy_medium")
    fuzzy = left.join(scored, (left["q"] == scored["q"]) & left["d"].eqNullSafe(scored["d"])).select("id", "slug", "score", how.alias("how"))
    return requests.join(exact.unionByName(fuzzy), "id", "left").withColumns({"how": F.coalesce("how", F.lit("rejected")), "score": F.coalesce("score", F.lit(0.0))})


def resolve_departments(requests: DataFrame, known: DataFrame) -> DataFrame:
    """id, department, slug: all places of the best-matching department (ratio 88 or more)."""
    depts = known.select(normalize_place(F.col("department"), "slug").alias("slug")).distinct().withColumn("department", F.lit(""))
    hit = resolve_places(requests.select("id", F.col("department").alias("place")), depts).where("how in ('exact', 'fuzzy_high')")
    k = known.select(normalize_place(F.col("department"), "slug").alias("__d"), F.col("slug").alias("place_slug"))
    return hit.join(k, F.col("slug") == F.col("__d")).select("id", F.col("slug").alias("department"), F.col("place_slug").alias("slug"))


def parse_places(texts: DataFrame, known: DataFrame) -> DataFrame:
    """id, seq, slug: the known places that a text (id, text) names, in order, each once.

    A piece (cut at commas, semicolons and ' y ') is taken by its exact slug, else by the best ratio of 88 or more if
    it has three letters and is no stop word; else its words of four letters or more are tried exactly.
    """
    pieces = texts.select("id", F.posexplode(F.split("text", r"[,;]|\sy\s")).alias("seq", "place")).where("trim(place) != ''")
    rows = pieces.withColumn("pid", F.concat_ws(":", "id", "seq"))
    q = normalize_place(F.col("place"), "slug")
    slugs = known.select("slug").distinct()
    exact = rows.withColumn("slug", q).join(slugs, "slug", "left_semi").select("pid", "id", "seq", F.lit(0).alias("word"), "slug")
    left = rows.join(exact.select("pid"), "pid", "left_anti")
    fuzzy_in = left.where((F.length(q) >= 3) & ~q.isin(STOP_WORDS)).select(F.col("pid").alias("id"), "place")
    fuzzy = resolve_places(fuzzy_in, known.withColumn("department", F.lit(""))).where("how = 'fuzzy_high'").select(F.col("id").alias("pid"), "slug").join(rows.select("pid", "id", "seq"), "pid").select("pid", "id", "seq", F.lit(0).alias("word"), "slug")
    words = left.join(fuzzy.select("pid"), "pid", "left_anti").select("pid", "id", "seq", F.posexplode(F.split("place", r"\s+")).alias("word", "w")).withColumn("slug", normalize_place(F.col("w"), "slug"))
    words = words.where((F.length("slug") >= 4) & ~F.col("slug").isin(STOP_WORDS)).join(slugs, "slug", "left_semi").select("pid", "id", "seq", "word", "slug")
    return first_per_key(exact.unionByName(fuzzy).unionByName(words), ["id", "slug"], [F.asc("seq"), F.asc("word")]).select("id", "seq", "slug")


def title_of(slug: Column, names: dict[str, str]) -> Column:
    from entityspark.functions.text import slug_to_title

    return slug_to_title(slug, names)

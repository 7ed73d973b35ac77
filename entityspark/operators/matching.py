"""Links between records: equal keys, similar names and addresses, near coordinates; first rule wins."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import text as X
from entityspark.storage import materialize

#: Rule name, keys, score and length guard of the exact rules, in order of precedence.
EXACT_RULES = [("name_place", ["name_norm", "place_norm"], 100, "length(name_norm) >= 4"), ("nit", ["key_nit"], 100, "length(key_nit) >= 8"),
               ("register_id", ["register_id"], 100, "register_id != ''"), ("email_place", ["email_norm", "place_norm"], 85, "email_norm != ''"),
               ("phone_place", ["phone_norm", "place_norm"], 85, "length(phone_norm) >= 7")]
RULE_ORDER = [r[0] for r in EXACT_RULES] + ["similar_name", "similar_address", "near_name"]
DECISIONS = ["auto_match", "pending", "ia_match", "no_match"]


def match_on(d: DataFrame, keys: list[str], rule: str, score: int, decision: str = "auto_match", guard: str = "true", pairs: str = "all") -> DataFrame:
    """a, b, rule, score, decision: pairs of records with equal keys.

    pairs='all' gives every pair; 'star' links each record with the smallest of its key instead: the same clusters with
    one row per record, for keys that many records share.
    """
    d = d.where(guard).where(" and ".join(f"{k} is not null" for k in keys)).select("record_id", *keys)
    if pairs == "star":
        least = d.groupBy(*keys).agg(F.min("record_id").alias("a"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
        out = d.join(least, keys).where("record_id != a").select("a", F.col("record_id").alias("b"))
    else:
        out = d.withColumnRenamed("record_id", "a").join(d.withColumnRenamed("record_id", "b"), keys).where("a < b").select("a", "b")
    return out.select("a", "b", F.lit(rule).alias("rule"), F.lit(score).alias("score"), F.lit(decision).alias("decision"))


#: Strings of a place under one trigram that meet in one task's key at most, about.
SLICE = 2000


def _bitmap(grams: str, words: int = 4) -> list[Column]:
    """A set as bits: 64-bit integers, in which every element sets one bit."""
    return [F.expr(f"aggregate({grams}, 0L, (a, x) -> if(pmod(shiftright(x, 6), {words}) = {i}, a | shiftleft(1L, cast(x & 63 as int)), a))") for i in range(words)]


def _may_be_alike(x: str, y: str, low: float) -> str:
    """Condition on sizes n and bitmaps b0 to b3 of two sets that every pair of at least that similarity meets: each bit
    that differs stands for an element that only one side has, and the threshold bounds their number."""
    differ = " + ".join(f"bit_count({x}b{i} ^ {y}b{i})" for i in range(4))
    return f"{x}n >= {y}n * {low} and {y}n >= {x}n * {low} and {differ} <= ({x}n + {y}n) * {(1 - low) / (1 + low)!r}"


def _similar_strings(texts: DataFrame, threshold: float) -> DataFrame:
    """x, y, similarity: pairs (x < y) of the ids of a block's distinct strings (blk, sid, g: hashes of the trigrams)."""
    # the float comparison may round up by half a unit in the last place
    low = threshold - 1e-6
    d = texts.select("blk", "sid", F.size("g").alias("n"), "g", *(b.alias(f"b{i}") for i, b in enumerate(_bitmap("g"))))
    grams = d.select("blk", "sid", F.explode("g").alias("gram"))
    freq = grams.groupBy("blk", "gram").agg(F.count("*").alias("f"))
    ranked = grams.join(freq, ["blk", "gram"]).groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("f", "gram"))).alias("r"))
    prefix = d.drop("g").join(ranked, "sid").withColumn("p", F.explode(F.slice("r", F.lit(1), (F.col("n") - F.ceil(F.col("n") * low) + 1).cast("int"))))
    prefix = prefix.where("p.f > 1").select("blk", "sid", "n", "b0", "b1", "b2", "b3", "p.gram", F.ceil(F.col("p.f") / SLICE).cast("int").alias("of"))
    own, every = F.pmod(F.xxhash64("sid"), F.col("of")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    x, y = prefix.withColumn("slice", own).alias("x"), prefix.withColumn("slice", every).alias("y")
    near = x.join(y, ["blk", "gram", "slice"]).where(f"x.sid < y.sid and {_may_be_alike('x.', 'y.', low)}")
    near = near.select(F.col("x.sid").alias("x"), F.col("y.sid").alias("y")).distinct()
    side = lambda c: texts.select(F.col("sid").alias(c), F.col("g").alias(f"{c}g"))
    alike = near.join(side("x"), "x").join(side("y"), "y").withColumn("similarity", X.set_similarity(F.col("xg"), F.col("yg")))
    return alike.where(F.col("similarity") >= threshold).select("x", "y", "similarity")


def _alike(texts: DataFrame, threshold: float) -> DataFrame:
    """x, y, similarity: pairs of the ids of a block's similar strings (blk, s, sid). Where blocks share most of their
    strings, the distinct strings of all blocks are compared once, and a pair goes to the blocks that hold both sides;
    else each block compares its own. Both give the same pairs."""
    grams = F.transform(X.trigrams(F.col("s")), lambda t: F.xxhash64(t)).alias("g")
    forms = materialize(texts.groupBy("s").agg(F.min("sid").alias("form")).select("s", "form", grams).where(F.size("g") > 0))
    squares = texts.groupBy("blk").agg(F.count("*").alias("n")).agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0
    n = forms.count()
    if n * n > squares:
        return _similar_strings(materialize(texts.join(forms, "s").select("blk", "sid", "g")), threshold)
    pairs = _similar_strings(forms.select(F.lit("").alias("blk"), F.col("form").alias("sid"), "g"), threshold)
    held = texts.join(forms.select("s", "form"), "s").select("blk", "sid", "form")
    return pairs.join(held.toDF("blk", "u", "x"), "x").join(held.toDF("blk", "v", "y"), ["blk", "y"]).select(F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y"), "similarity")


def similarity_join(d: DataFrame, column: str, threshold: float, block: str | None, id_col: str = "record_id", left_min: int = 0, right_min: int = 0, pairs: str = "all",
                    keep: list[str] | None = None) -> DataFrame:
    """a, b, similarity: pairs (a < b) of a block whose trigram similarity reaches the threshold, exactly (64-bit hashes
    stand for trigrams).

    A pair that similar shares a trigram among the rarest of each side, and sizes within the threshold's ratio: each
    string is sent under its (size - ceil(t * size) + 1) rarest trigrams of its block only, so the join key is (block,
    trigram), in slices where many strings share it, and never the block alone. Bitmaps of the sets part most pairs
    inside the join. Equal strings of a block are one row named by its smallest id until the end; pairs='all' then gives
    every pair of records, with the columns in keep of both under a_ and b_, 'star' links the strings' first records, and
    each record with the first of its string.
    """
    keep = keep or []
    key = F.col(block) if block else F.lit("")
    rows = d.where(F.col(column).isNotNull() & key.isNotNull()).select(F.col(id_col).alias("id"), key.alias("blk"), F.col(column).alias("s"), *(F.col(c).alias(f"_{c}") for c in keep))
    texts = materialize(rows.groupBy("blk", "s").agg(F.min("id").alias("sid")).where(F.size(X.trigrams(F.col("s"))) > 0))
    alike = materialize(_alike(texts, threshold))
    named = rows.join(texts, ["blk", "s"]).select("id", "sid", F.length("s").alias("len"), *(f"_{c}" for c in keep))
    if pairs == "star":
        first = named.where("id = sid").select("sid", "len")
        out = alike.join(first.toDF("x", "lx"), "x").join(first.toDF("y", "ly"), "y").select(F.col("x").alias("a"), F.col("y").alias("b"), "similarity", "lx", "ly")
        out = out.unionAll(named.where("id != sid").select(F.col("sid").alias("a"), F.col("id").alias("b"), F.lit(1.0), F.col("len"), F.col("len")))
        return out.where(f"lx >= {left_min} and ly >= {right_min}").select("a", "b", "similarity")
    named = materialize(named)
    side = lambda c, x, l: named.select(F.col("id").alias(c), F.col("sid").alias(x), F.col("len").alias(l), *(F.col(f"_{k}").alias(f"{c}_{k}") for k in keep))  # noqa: E731, E741
    out = alike.unionAll(texts.select("sid", "sid", F.lit(1.0))).join(side("u", "x", "lu"), "x").join(side("v", "y", "lv"), "y").where("x != y or u < v")
    first = lambda u, v: F.when(F.col("u") < F.col("v"), F.col(u)).otherwise(F.col(v))
    out = out.select(first("u", "v").alias("a"), first("v", "u").alias("b"), "similarity", first("lu", "lv").alias("la"), first("lv", "lu").alias("lb"),
                     *(first(f"{s}_{k}", f"{t}_{k}").alias(f"{c}_{k}") for c, s, t in (("a", "u", "v"), ("b", "v", "u")) for k in keep))
    return out.where(f"la >= {left_min} and lb >= {right_min}").drop("la", "lb")


def similar_names(d: DataFrame, threshold: float = 0.75, pairs: str = "all", keep: list[str] | None = None) -> DataFrame:
    p = similarity_join(d.where("length(name_norm) >= 4"), "name_norm", threshold, "place_norm", pairs=pairs, keep=keep)
    score = F.when(F.col("similarity") >= 0.85, 85).when(F.col("similarity") >= 0.80, 80).otherwise(75)
    return p.select("a", "b", F.lit("similar_name").alias("rule"), score.alias("score"), F.lit("pending").alias("decision"), *(f"{s}_{c}" for s in "ab" for c in keep or []))


def similar_addresses(d: DataFrame, threshold: float = 0.80, pairs: str = "all") -> DataFrame:
    p = similarity_join(d, "address_norm", threshold, "place_norm", left_min=8, pairs=pairs)
    return p.select("a", "b", F.lit("similar_address").alias("rule"), F.lit(70).alias("score"), F.lit("pending").alias("decision"))


def near_pairs(d: DataFrame, metres: float = 50.0, box: float = 0.001, null_island: str = "drop", keep: list[str] | None = None, also: str = "true") -> DataFrame:
    """a, b and x_/y_ columns: pairs of points inside the box and the distance. Points are dealt to cells of the box's
    size; one side is sent to the nine cells around it, so the join has an equality key and no cell meets all others.
    null_island='drop' leaves out (0, 0), where listings without a place pile up; also: a condition that is tried before
    the distance."""
    keep = keep or []
    d = d.where("lat is not null and lon is not null").select("record_id", "lat", "lon", *keep)
    if null_island == "drop":
        d = d.where("not (lat = 0 and lon = 0)")
    cell = {"ci": F.floor(F.col("lat") / box), "cj": F.floor(F.col("lon") / box)}
    x = d.withColumns(cell).select("ci", "cj", F.col("record_id").alias("a"), *(F.col(c).alias(f"x_{c}") for c in ["lat", "lon", *keep]))
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    y = d.withColumns(cell).withColumn("o", around).select((F.col("ci") + F.col("o.i")).alias("ci"), (F.col("cj") + F.col("o.j")).alias("cj"), F.col("record_id").alias("b"), *(F.col(c).alias(f"y_{c}") for c in ["lat", "lon", *keep]))
    j = x.join(y, ["ci", "cj"]).where(f"a < b and abs(x_lat - y_lat) < {box} and abs(x_lon - y_lon) < {box} and {also}")
    return j.where(X.distance_m(F.col("x_lat"), F.col("x_lon"), F.col("y_lat"), F.col("y_lon")) < metres)


#: Points of a cell of the box's size from which on it counts as crowded.
CROWDED = 500


def _crowded_pairs(points: DataFrame, hot: DataFrame, threshold: float, metres: float, box: float) -> DataFrame:
    """a, b: similar names at near points of which one at least lies in a crowded cell. Points in and around these cells
    are dealt to squares of twice the box in four grids, half a square apart, so every two within the box share one.
    In a square similar names meet as those of a place do, by rare trigrams in slices; distances follow for what is left."""
    around = F.explode(F.array(*(F.struct((F.col("ci") + i).alias("ci"), (F.col("cj") + j).alias("cj")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    p = points.join(hot.select(around.alias("o")).select("o.*").distinct(), ["ci", "cj"], "left_semi").join(hot.withColumn("crowded", F.lit(True)), ["ci", "cj"], "left")
    at = lambda c, shift: F.floor(F.col(c) / (2 * box) + shift / 2)
    squares = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), at("lat", i).alias("si"), at("lon", j).alias("sj")) for i in (0, 1) for j in (0, 1)))
    rows = p.withColumn("square", F.explode(squares)).select(F.struct("square", "record_id", "lat", "lon", "crowded").alias("id"), "square", "name_norm")
    alike = similarity_join(rows, "name_norm", threshold, "square", id_col="id")
    near = (F.abs(F.col("a.lat") - F.col("b.lat")) < box) & (F.abs(F.col("a.lon") - F.col("b.lon")) < box) & (X.distance_m(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) < metres)
    return alike.where(near & F.coalesce("a.crowded", "b.crowded")).select(F.col("a.record_id").alias("a"), F.col("b.record_id").alias("b")).distinct()


def _plain_pairs(points: DataFrame, threshold: float, metres: float, box: float) -> DataFrame:
    """a, b: similar names at near points. Points meet with their names' sizes and bitmaps; trigrams are compared once
    for each two different names that come through."""
    low = threshold - 1e-6
    grams = F.transform(X.trigrams(F.col("name_norm")), lambda t: F.xxhash64(t)).alias("g")
    names = materialize(points.where("name_norm is not null").groupBy("name_norm").agg(F.min("record_id").alias("f")).select("name_norm", "f", grams).where(F.size("g") > 0))
    bits = names.select("name_norm", "f", F.size("g").alias("n"), *(b.alias(f"b{i}") for i, b in enumerate(_bitmap("g"))))
    met = near_pairs(points.join(bits, "name_norm"), metres, box, "keep", keep=["f", "n", *(f"b{i}" for i in range(4))], also=_may_be_alike("x_", "y_", low))
    met = materialize(met.select("a", "b", F.least("x_f", "y_f").alias("x"), F.greatest("x_f", "y_f").alias("y")))
    g = names.select("f", "g")
    alike = met.select("x", "y").where("x != y").distinct().join(g.toDF("x", "xg"), "x").join(g.toDF("y", "yg"), "y").where(X.set_similarity(F.col("xg"), F.col("yg")) >= threshold).select("x", "y")
    return met.where("x = y").select("a", "b").unionAll(met.join(alike, ["x", "y"]).select("a", "b"))


def near_names(d: DataFrame, threshold: float = 0.70, null_island: str = "drop", metres: float = 50.0, box: float = 0.001, crowded: int | None = None) -> DataFrame:
    """Similar names at points nearer than metres. Points of a cell meet those of the nine around it, but for crowded
    cells (a shopping centre), whose pairs come from their names first: see _crowded_pairs. The pairs are the same."""
    p = d.where("lat is not null and lon is not null")
    p = p.where("not (lat = 0 and lon = 0)") if null_island == "drop" else p
    p = p.select("record_id", "lat", "lon", "name_norm", F.floor(F.col("lat") / box).alias("ci"), F.floor(F.col("lon") / box).alias("cj"))
    hot = materialize(p.groupBy("ci", "cj").agg(F.count("*").alias("n")).where(F.col("n") > (crowded or CROWDED)).select("ci", "cj"))
    some = not hot.isEmpty()
    plain = p.join(hot, ["ci", "cj"], "left_anti") if some else p
    q = _plain_pairs(plain, threshold, metres, box)
    if some:
        q = q.unionAll(_crowded_pairs(p, hot, threshold, metres, box))
    return q.select("a", "b", F.lit("near_name").alias("rule"), F.lit(80).alias("score"), F.lit("pending").alias("decision"))


def resolve_rules(found: list[DataFrame]) -> DataFrame:
    """One row per pair: of all rules that link it the first in RULE_ORDER."""
    rank = F.array_position(F.array(*(F.lit(r) for r in RULE_ORDER)), F.col("rule"))
    all_ = reduce(lambda x, y: x.unionByName(y), found).withColumn("rank", rank)
    return all_.groupBy("a", "b").agg(F.min_by(F.struct("rule", "score", "decision"), "rank").alias("m")).select("a", "b", "m.*")


def _first_rule(found: list[DataFrame]) -> DataFrame:
    """resolve_rules() of this module's rules and decisions: rank, score and decision are the digits of one integer, whose
    least is kept by hash, where structs would be sorted."""
    rules, decisions = (F.array(*map(F.lit, x)) for x in (RULE_ORDER, DECISIONS))
    code = F.array_position(rules, F.col("rule")) * 10_000 + F.col("score") * 10 + F.array_position(decisions, F.col("decision"))
    m = reduce(lambda x, y: x.unionAll(y), (f.select("a", "b", code.alias("m")) for f in found)).groupBy("a", "b").agg(F.min("m").alias("m"))
    return m.select("a", "b", F.element_at(rules, F.expr("cast(m div 10000 as int)")).alias("rule"), F.expr("cast(m div 10 % 1000 as int)").alias("score"), F.element_at(decisions, F.expr("cast(m % 10 as int)")).alias("decision"))


def exact_rules(d: DataFrame) -> list[tuple[str, list[str], int, str]]:
    """The rules whose columns d has."""
    return [r for r in EXACT_RULES if all(k in d.columns for k in r[1])]


def exact_matches(d: DataFrame, pairs: str = "all", keep: list[str] | None = None) -> DataFrame:
    """a, b, rule, score, decision of the exact rules' links, under keep's columns as a_ and b_ beside them: one row for
    each pair, by its first rule. Pairs are not shuffled: with all keys at hand a rule leaves a pair that an earlier one
    links to that. With pairs='star' each rule has its stars."""
    rules, keep = exact_rules(d), keep or []
    if pairs == "star":
        return _first_rule([match_on(d, keys, rule, score, guard=guard, pairs=pairs) for rule, keys, score, guard in rules])
    columns, out = list(dict.fromkeys([*(k for r in rules for k in r[1]), *keep])), []
    for i, (rule, keys, score, guard) in enumerate(rules):
        rows = d.where(guard).where(" and ".join(f"{k} is not null" for k in keys)).select("record_id", *columns)
        side = lambda s, names: rows.select(F.col("record_id").alias(s), *keys, *(F.col(c).alias(f"{s}_{c}") for c in names))  # noqa: E731, B023
        earlier = [c for c in dict.fromkeys(k for r in rules[:i] for k in r[1]) if c not in keys]
        beside = list(dict.fromkeys([*earlier, *keep]))
        both = side("a", beside).join(side("b", beside), keys).where("a < b")
        for _, before, _, hold in rules[:i]:
            both = both.where(~_linked(before, hold, "a_", "b_", keys))
        out.append(both.select("a", "b", F.lit(rule).alias("rule"), F.lit(score).alias("score"), F.lit("auto_match").alias("decision"), *(f"{s}_{c}" for s in "ab" for c in keep)))
    return reduce(lambda x, y: x.unionAll(y), out)


def _linked(keys: list[str], guard: str, a: str, b: str, equal: list[str] = ()) -> Column:
    """Whether a rule links two records whose columns stand under the prefixes a and b; those in equal, which both share,
    under their own names."""
    held = guard
    for k in keys:
        held = re.sub(rf"\b{k}\b", k if k in equal else a + k, held)
    same = [f"{k} is not null" if k in equal else f"{a}{k} = {b}{k}" for k in keys]
    return F.coalesce(F.expr(" and ".join([f"({held})", *same])), F.lit(False))


def all_matches(d: DataFrame, pairs: str = "all") -> DataFrame:
    """a, b, rule, score, decision: the links of all rules, the first rule for each pair. With pairs='star' shared keys
    and equal strings are stars, one row per record, and every pair has the rule it has among all pairs."""
    used = {"record_id", "name_norm", "place_norm", "address_norm", "lat", "lon", *(k for r in exact_rules(d) for k in r[1])}
    d = materialize(d.select(*(c for c in d.columns if c in used)))
    out = _first_rule([exact_matches(d, pairs), similar_names(d, pairs=pairs), similar_addresses(d, pairs=pairs), near_names(d)])
    return first_exact_rule(out, d) if pairs == "star" else out


def first_exact_rule(matches: DataFrame, d: DataFrame) -> DataFrame:
    """matches with the first exact rule that holds between both records, where one does: stars leave out most pairs of
    a key, of which a later rule may link some."""
    rules = exact_rules(d)
    keys = [F.when(F.expr(guard) & F.expr(" and ".join(f"{k} is not null" for k in ks)), F.struct(*ks)).alias(f"k{i}") for i, (_, ks, _, guard) in enumerate(rules)]
    side = lambda c: d.select(F.col("record_id").alias(c), *(k.alias(f"{c}{i}") for i, k in enumerate(keys)))
    j = matches.join(side("a"), "a").join(side("b"), "b")
    first = F.coalesce(*(F.when(F.col(f"a{i}") == F.col(f"b{i}"), F.struct(F.lit(rule).alias("rule"), F.lit(score).alias("score"), F.lit("auto_match").alias("decision"))) for i, (rule, _, score, _) in enumerate(rules)))
    return j.select("a", "b", F.coalesce(first, F.struct("rule", "score", "decision")).alias("m")).select("a", "b", "m.*")


def exact_pairs_per_entity(clustered: DataFrame) -> DataFrame:
    """entity, n: how many pairs of an entity's records at least one exact rule links, without making the pairs: by
    inclusion and exclusion over the groups of equal keys of every set of rules."""
    rules = exact_rules(clustered)
    sets = [[j for j in range(len(rules)) if i >> j & 1] for i in range(1, 1 << len(rules))]

    def key(some: list[int]) -> Column:
        names = sorted({k for j in some for k in rules[j][1]})
        holds = " and ".join(f"({rules[j][3]})" for j in some) + "".join(f" and {k} is not null" for k in names)
        return F.when(F.expr(holds), F.struct(F.lit(1 if len(some) % 2 else -1).alias("sign"), F.lit(",".join(map(str, some))).alias("rules"), F.to_json(F.array(*names)).alias("key")))

    rows = clustered.select("entity", F.explode(F.array(*map(key, sets))).alias("k")).where("k is not null")
    groups = rows.groupBy("entity", "k").agg(F.count("*").alias("c")).where("c > 1")
    return groups.groupBy("entity").agg(F.sum(F.expr("k.sign * (c * (c - 1)) div 2")).alias("n"))


def unmatched(pairs: DataFrame, known: DataFrame) -> DataFrame:
    return pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")


def similar_names_only(d: DataFrame, keep: list[str]) -> DataFrame:
    """The similar names' links between records that no exact rule links, with keep's columns of both: their keys stand
    beside them, so the exact rules' pairs are not made."""
    rules = exact_rules(d)
    keys = list(dict.fromkeys(k for r in rules for k in r[1]))
    p = similar_names(d, keep=list(dict.fromkeys([*keys, *keep])))
    for _, ks, _, guard in rules:
        p = p.where(~_linked(ks, guard, "a_", "b_"))
    return p.select("a", "b", "rule", "score", "decision", *(f"{s}_{c}" for s in "ab" for c in keep))


def hydrate(matches: DataFrame, records: DataFrame, columns: list[str]) -> DataFrame:
    """Both records' columns beside each pair, under a_ and b_."""
    for side in ("a", "b"):
        matches = matches.join(records.select(F.col("record_id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)), side)
    return matches


def match_stats(matches: DataFrame) -> DataFrame:
    kinds = ["auto_match", "pending", "ia_match", "no_match"]
    return matches.agg(*(F.count_if(F.col("decision") == k).alias(k) for k in kinds), F.count("*").alias("total"))


def review_candidates(matches: DataFrame, low: int = 68, high: int = 74, batch: int = 100) -> DataFrame:
    return matches.where(f"decision = 'pending' and score between {low} and {high}").orderBy(F.desc("score"), "a", "b").limit(batch)


def apply_verdicts(matches: DataFrame, verdicts: DataFrame) -> DataFrame:
    """verdicts: a, b, verdict (same, different, anything else is ignored), reason, confidence."""
    v = verdicts.where("verdict in ('same', 'different')").select("a", "b", F.when(F.col("verdict") == "same", "ia_match").otherwise("no_match").alias("__d"), "reason", "confidence")
    return matches.join(v, ["a", "b"], "left").withColumn("decision", F.coalesce("__d", "decision")).drop("__d")


def confirmed(matches: DataFrame) -> DataFrame:
    return matches.where("decision in ('auto_match', 'ia_match')")

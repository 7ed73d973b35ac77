"""The best-scored candidate of each row, by upper bounds that cost less than the score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.storage import materialize, release

#: Kinds of characters that are counted: these each (in either case), digits together, all others together.
LETTERS = " -ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits for a kind's count, and kinds in an integer of 64 bits.
COPIES = 8
BITMAPS = [f"__b{i}" for i in range(-(-(len(LETTERS) + 2) // COPIES))]


def with_letter_bits(d: DataFrame, s: str) -> DataFrame:
    """Adds how often each kind of character stands in the string column s: as many ones as there are, up to COPIES, in
    the kind's place of a bitmap; __over counts what is beyond."""
    u, n = F.upper(s), F.length(s)
    each = [n - F.length(F.replace(u, F.lit(x), F.lit(""))) for x in LETTERS] + [n - F.length(F.translate(s, "0123456789", ""))]
    d = d.withColumn("__n", F.array(*each))
    d = d.withColumn("__n", F.concat("__n", F.array(n - F.aggregate("__n", F.lit(0), lambda a, x: a + x))))
    ones = lambda i: F.shiftleft((F.call_function("shiftleft", F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("__n")[i])) - 1), i % COPIES * COPIES)
    words = {name: sum((ones(i) for i in range(j * COPIES + 1, min(j * COPIES + COPIES, len(LETTERS) + 2))), ones(j * COPIES)) for j, name in enumerate(BITMAPS)}
    over = F.aggregate("__n", F.lit(0), lambda a, x: a + F.greatest(F.lit(0), x - COPIES))
    return d.withColumns(words | {"__over": over}).drop("__n")


def common_letters(x: str = "x", y: str = "y") -> Column:
    """At least the length of the longest common subsequence of the two strings: the bits that both have, which a few
    machine instructions count."""
    return sum((F.bit_count(F.col(f"{x}.{b}").bitwiseAND(F.col(f"{y}.{b}"))) for b in BITMAPS), F.least(F.col(f"{x}.__over"), F.col(f"{y}.__over")))


#: Pairs that one task of a sliced join works off, about.
TASK_PAIRS = 500_000


def sliced_join(p: DataFrame, c: DataFrame, size: int = 500) -> DataFrame:
    """Pairs of rows with equal k under x and y. A key's rows are sliced by their s on both sides, about `size` to a
    slice, and every slice meets every other under a key of its own, so that no key grows with the rows that share it."""
    counts = [d.groupBy("k").agg(F.count("*").alias(f"n{side}"), F.ceil(F.count("*") / size).cast("int").alias(side)) for side, d in (("i", p), ("j", c))]
    both = materialize(counts[0].join(counts[1], "k"))
    # the bytes of a side say little about the pairs, so the number of tasks comes from them
    tasks = int(-(-(both.agg(F.sum(F.col("ni") * F.col("nj"))).first()[0] or 0) // TASK_PAIRS)) or 1
    p, c = (d.join(both.select("k", "i", "j"), "k") for d in (p, c))
    own = lambda m: F.pmod(F.xxhash64("s"), F.col(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    p = p.withColumn("u", own("i")).withColumn("v", every("j"))
    c = c.withColumn("v", own("j")).withColumn("u", every("i"))
    p, c = (d.repartition(tasks, "k", "u", "v") for d in (p, c))
    # a task holds a few slices of c, so a hash table of them is small
    return p.alias("x").join(c.alias("y").hint("shuffle_hash"), F.expr("x.k = y.k and x.u = y.u and x.v = y.v"))


def best_candidates(rows: DataFrame, meet: Callable[[DataFrame], DataFrame], key: list[str], candidate: dict[str, Column], bound: Column, score: Callable[[Column], Column], first: str, least: float) -> DataFrame:
    """key, candidate, score: for every row the candidate with the best score, the smallest in the candidate's field
    `first` on ties; rows without one of at least `least` are left out.

    meet(rows) gives each row, as x, with its candidates, as y; candidate names what of the pair is kept, bound is never
    below the score, and score works on a struct of key, candidate and low. The candidate of the highest bound is scored
    first, one for each row. Pairs then have to reach what that found, so few are scored, and none that could win is
    left out.
    """
    keys = [F.col(f"x.{k}").alias(k) for k in key]
    pair = F.struct(*(c.alias(n) for n, c in candidate.items()))
    scored = lambda d: d.withColumn("score", score(F.struct(*key, "c")))
    start = meet(rows).where(bound >= least).select(*keys, pair.alias("c"), bound.alias("b")).groupBy(*key).agg(F.max_by("c", "b").alias("c"))
    low = materialize(scored(start).select(*key, F.greatest("score", F.lit(least)).alias("low")))
    pairs = meet(rows.join(low, key)).where(bound >= F.col("x.low")).select(*keys, pair.alias("c"))
    out = scored(pairs).groupBy(*key).agg(F.min_by(F.struct("c", "score"), F.struct(-F.col("score"), f"c.{first}")).alias("m"))
    out = materialize(out.select(*key, "m.c", "m.score").where(F.col("score") >= least))
    release(low)
    return out.select(*key, F.col("c").alias("candidate"), "score")

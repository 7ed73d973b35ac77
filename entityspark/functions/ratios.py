"""Fuzzy string ratios (0 to 100) as column expressions: normalised insert-and-delete similarity, for which Spark has no
built-in. Longest common subsequences are found bit-parallel: the shorter string's positions are bits of integers, and
each letter of the other costs one sum."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a row that one integer holds; sums of two rows and a carry stay below 2^63.
WORD = 62
_FULL = (1 << WORD) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def letters(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _bits(n: Column) -> Column:
    """n ones, n up to WORD."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int")) - 1


def letter_masks(s: Column) -> Column:
    """For each letter of a string the bits of its places, WORD places to an integer."""
    def of(chars: Column) -> Column:
        step = lambda acc, c, d: F.struct((acc["bit"] * 2).alias("bit"), (acc["sum"] + F.when(c == d, acc["bit"]).otherwise(F.lit(0).cast("long"))).alias("sum"))
        zero = F.struct(F.lit(1).cast("long").alias("bit"), F.lit(0).cast("long").alias("sum"))
        word = lambda w, d: F.aggregate(F.slice(chars, w * WORD + 1, F.lit(WORD)), zero, lambda acc, c: step(acc, c, d), lambda acc: acc["sum"])
        words = F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / WORD).cast("int"))
        return _let(F.array_distinct(chars), lambda kinds: F.map_from_arrays(kinds, F.transform(kinds, lambda d: F.transform(words, lambda w: word(w, d)))))

    def short(t: Column) -> Column:
        """One integer: every letter in turn becomes 1 and all others 0, which read as a binary number."""
        size = F.size(t["kinds"])
        digits = lambda i: F.concat(F.repeat(F.lit("0"), i), F.lit("1"), F.repeat(F.lit("0"), size - i - 1))
        word = lambda i: F.conv(F.call_function("translate", t["back"], t["all"], digits(i)), 2, 10).cast("long")
        return F.map_from_arrays(t["kinds"], F.transform(t["kinds"], lambda d, i: F.array(word(i))))

    kinds = lambda k: F.struct(k.alias("kinds"), F.array_join(k, "").alias("all"), F.reverse(s).alias("back"))
    few = _let(F.array_distinct(letters(s)), lambda k: _let(kinds(k), short))
    return F.when(F.length(s) > WORD, _let(letters(s), of)).when(F.length(s) > 0, few)


def common(n: Column, masks: Column, others: Column) -> Column:
    """Length of the longest common subsequence of a string of n > 0 letters, given by its masks, and an array of letters."""
    hit = lambda c: F.try_element_at(masks, c)

    def one(full: Column) -> Column:
        def step(row: Column, c: Column) -> Column:
            m = F.coalesce(hit(c)[0], F.lit(0).cast("long"))
            return (row + row.bitwiseAND(m)).bitwiseOR(row.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full)

        return n - F.bit_count(F.aggregate(others, full, step))

    def step(row: Column, m: Column, full: Column) -> Column:
        def word(acc: Column, w: Column) -> Column:
            s = row[w] + row[w].bitwiseAND(m[w]) + acc["carry"]
            new = s.bitwiseOR(row[w].bitwiseAND(F.bitwise_not(m[w]))).bitwiseAND(full[w])
            return F.struct(F.shiftright(s, WORD).alias("carry"), F.concat(acc["row"], F.array(new)).alias("row"))

        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("row"))
        return F.aggregate(F.sequence(F.lit(0), F.size(full) - 1), start, word, lambda acc: acc["row"])

    full = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / WORD).cast("int")), lambda w: _bits(F.least(F.lit(WORD), n - w * WORD)))
    many = _let(full, lambda f: F.aggregate(others, f, lambda row, c: _let(hit(c), lambda m: F.when(m.isNull(), row).otherwise(step(row, m, f))),
                                            lambda row: F.aggregate(row, n, lambda left, x: left - F.bit_count(x))))
    return F.when(n <= WORD, _let(_bits(n), one)).otherwise(many)


def _sided(a: Column, b: Column, body: Callable[[Column], Column]) -> Column:
    """body of a struct short, long, n, m: the shorter string (a on a tie), the other, their lengths; null for a null."""
    order = lambda t: F.struct(F.when(F.length(t["a"]) <= F.length(t["b"]), t["a"]).otherwise(t["b"]).alias("short"), F.when(F.length(t["a"]) <= F.length(t["b"]), t["b"]).otherwise(t["a"]).alias("long"))
    sizes = lambda t: F.struct(t["short"].alias("short"), t["long"].alias("long"), F.length(t["short"]).alias("n"), F.length(t["long"]).alias("m"))
    known = lambda t: F.when(t["a"].isNotNull() & t["b"].isNotNull(), _let(order(t), lambda u: _let(sizes(u), body)))
    return _let(F.struct(a.alias("a"), b.alias("b")), known)


def _lcs(t: Column) -> Column:
    return F.when(t["n"] == 0, 0).otherwise(_let(letter_masks(t["short"]), lambda m: common(t["n"], m, letters(t["long"]))))


def lcs(a: Column, b: Column) -> Column:
    return _sided(a, b, _lcs)


def _scaled(both: Column, total: Column) -> Column:
    return F.when(total == 0, 100.0).otherwise(both * 200.0 / F.greatest(total, F.lit(1)))


def ratio(a: Column, b: Column) -> Column:
    return _sided(a, b, lambda t: _scaled(_lcs(t), t["n"] + t["m"]))


def tokens(s: Column) -> Column:
    return F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")


def sorted_tokens(s: Column) -> Column:
    return F.array_join(F.array_sort(tokens(s)), " ")


def token_sort(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def partial(a: Column, b: Column) -> Column:
    """Best ratio of the shorter string against windows of the longer, those cut off at its ends included."""
    def windows(t: Column, u: Column) -> Column:
        def score(at: Column) -> Column:
            size = F.least(t["n"] + at, t["m"], t["n"], t["m"] - at)
            return _let(size, lambda w: _scaled(common(t["n"], u["masks"], F.slice(u["long"], F.greatest(at, F.lit(0)) + 1, w)), t["n"] + w))

        return F.array_max(F.transform(F.sequence(1 - t["n"], t["m"] - 1), score))

    found = lambda t: _let(F.struct(letter_masks(t["short"]).alias("masks"), letters(t["long"]).alias("long")), lambda u: windows(t, u))
    return _sided(a, b, lambda t: F.when(t["n"] > 0, found(t)).when(t["m"] == 0, 100.0).otherwise(0.0))


def token_set(a: Column, b: Column) -> Column:
    """The tokens that both have, in order, against these with the rest of either side, and these two: the best ratio."""
    joined = lambda x: F.array_join(F.array_sort(x), " ")

    def of(t: Column) -> Column:
        return F.struct(joined(F.array_intersect(t["x"], t["y"])).alias("both"), joined(F.array_except(t["x"], t["y"])).alias("x"), joined(F.array_except(t["y"], t["x"])).alias("y"))

    def best(t: Column) -> Column:
        n = F.length(t["both"])
        prefix = lambda c: _scaled(n, 2 * n + 1 + F.length(t[c]))
        plain = ratio(F.trim(F.concat_ws(" ", t["both"], t["x"])), F.trim(F.concat_ws(" ", t["both"], t["y"])))
        return F.when((n > 0) & ((t["x"] == "") | (t["y"] == "")), 100.0).otherwise(F.greatest(plain, F.when(n > 0, F.greatest(prefix("x"), prefix("y")))))

    sets = F.struct(F.array_distinct(tokens(a)).alias("x"), F.array_distinct(tokens(b)).alias("y"))
    return _let(sets, lambda t: F.when((F.size(t["x"]) > 0) & (F.size(t["y"]) > 0), _let(of(t), best)).when(t["x"].isNotNull() & t["y"].isNotNull(), 0.0))


def _weighted(a: Column, b: Column, near: Callable[[Column], Column], far: Callable[[Column, Column], Column]) -> Column:
    """By how much the lengths differ: near(pair), or far(pair, scale) with the scale of partial ratios."""
    share = lambda t: F.greatest(F.length(t["a"]), F.length(t["b"])) / F.greatest(F.least(F.length(t["a"]), F.length(t["b"])), F.lit(1))
    chosen = lambda t: _let(share(t), lambda r: F.when((t["a"] == "") | (t["b"] == ""), 0.0).when(r < 1.5, near(t)).otherwise(far(t, F.when(r <= 8, 0.9).otherwise(0.6))))
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda t: F.when(t["a"].isNotNull() & t["b"].isNotNull(), chosen(t)))


def wratio(a: Column, b: Column) -> Column:
    """The weighted best of the plain, partial and token forms, by how much the lengths differ."""
    return _weighted(a, b, lambda t: F.greatest(ratio(t["a"], t["b"]), 0.95 * token_sort(t["a"], t["b"]), 0.95 * token_set(t["a"], t["b"])),
                     lambda t, scale: F.greatest(ratio(t["a"], t["b"]), scale * partial(t["a"], t["b"]), 0.95 * scale * partial(sorted_tokens(t["a"]), sorted_tokens(t["b"]))))


def slug_ratio(a: Column, b: Column) -> Column:
    """wratio() of strings of one token each, whose token forms are the plain ones."""
    return _weighted(a, b, lambda t: ratio(t["a"], t["b"]), lambda t, scale: F.greatest(ratio(t["a"], t["b"]), scale * partial(t["a"], t["b"])))

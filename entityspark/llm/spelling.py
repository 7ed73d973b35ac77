"""Groups of spelling variants: words one edit apart, met through reduced words, each led to its commonest neighbour."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import arrow_batches, mix
from entityspark.storage import materialize, release

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters are reduced to so many symbols by their code points. Of eight, about five keys of a word of nine letters have a word.
SYMBOLS = 8
#: Words of one reduced form that meet in one key at most, about; beyond, they are sliced.
CELL = 4096
_R = np.uint64(0x9E3779B97F4A7C15)


def word_counts(docs: DataFrame, min_letters: int = 7, min_count: int = 2, drop_one_in: int = 31) -> DataFrame:
    """word, n of a frame with doc_id and text: maximal runs of letters, A-Z in lower case.

    In a run whose crc32 with its document is divisible by drop_one_in, one code point chosen by the same number is
    left out. Occurrences combine before the shuffle, so a word of any frequency costs one row a task.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    d = d.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    d = d.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    word = F.when(F.pmod("h", F.lit(drop_one_in)) == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return d.select(word.alias("word")).where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length as rows of symbols: the terms of their polynomial hashes, and the powers."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(s.shape[1], _R, np.uint64)]), dtype=np.uint64)
    return (s + np.uint64(1)) * powers[:-1], powers


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64))).view(np.int64)


def reduced_keys(s: np.ndarray) -> np.ndarray:
    """The key of every row of symbols."""
    terms, _ = _sums(s)
    return _key(terms.sum(1, dtype=np.uint64), s.shape[1])


def neighbour_keys(s: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the one-edit neighbourhood of reduced words: the word itself, each symbol left out, each
    replaced by a higher one. Lower replacements and insertions are the same steps seen from the other word, so every
    two reduced words at most one edit apart meet exactly once. Time and memory are linear in the letters."""
    m, length = s.shape
    terms, powers = _sums(s)
    total = terms.sum(1, dtype=np.uint64)
    rows, keys = [np.arange(m)], [_key(total, length)]
    if length > 1:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        shifted = (s[:, 1:] + np.uint64(1)) * powers[:length - 1]  # what stands behind, one place to the left
        after = np.zeros_like(terms)
        after[:, :-1] = np.cumsum(shifted[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        first = np.ones(s.shape, bool)
        first[:, 1:] = s[:, 1:] != s[:, :-1]  # of equal neighbours, one
        r, c = np.nonzero(first)
        rows.append(r)
        keys.append(_key((before + after)[r, c], length - 1))
    for step in range(1, symbols):
        r, c = np.nonzero(s + np.uint64(step) < symbols)
        rows.append(r)
        keys.append(_key(total[r] + np.uint64(step) * powers[c], length))
    return np.concatenate(rows), np.concatenate(keys)


def _by_length(words: pa.Array, symbols: int, most: int):
    """(rows, symbols of these rows) for words of one length, at most so many letters at once."""
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    lengths = np.asarray([len(w) for w in words.to_pylist()], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for n in np.unique(lengths):
        mine = np.flatnonzero(lengths == n)
        step = max(1, most // int(n))
        for at in range(0, len(mine), step):
            rows = mine[at:at + step]
            yield rows, (points[starts[rows][:, None] + np.arange(n)] % np.uint32(symbols)).astype(np.uint64)


def _keyed(words: DataFrame, symbols: int, whole: bool) -> DataFrame:
    """word, n, key: the key of every reduced word, or (whole) those of its neighbourhood."""
    def over(batches):
        for batch in batches:
            column = batch.column("word")
            for rows, s in _by_length(column, symbols, 1 << 16):
                r, k = neighbour_keys(s, symbols) if whole else (np.arange(len(s)), reduced_keys(s))
                take = pa.array(rows[r])
                yield pa.RecordBatch.from_arrays([column.take(take), batch.column("n").take(take), pa.array(k)], ["word", "n", "key"])

    return words.select("word", "n").mapInArrow(over, "word string, n long, key long")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, cell: int = CELL) -> DataFrame:
    """a, n_a, b, n_b: each two words (word, n; words are distinct) that differ by exactly one inserted, deleted or
    replaced code point, once.

    The neighbourhoods of reduced words join the reduced vocabulary on 64-bit keys, and the edit distance of the words
    themselves decides, inside the join. Of two words the longer generates, then the one whose reduced form (or, where
    these are equal, which itself) comes first; so a meeting by chance of keys gives no pair twice. Reduced forms of
    more than `cell` words are dealt to slices that each meet all keys.
    """
    codes = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))
    reduced = lambda c: F.translate(c, codes, "".join(chr(97 + ord(x) % symbols) for x in codes))
    vocabulary, keys = _keyed(words, symbols, False), _keyed(words, symbols, True)
    hot = materialize(vocabulary.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > cell).select("key", F.ceil(F.col("c") / cell).cast("int").alias("slices")))
    on = F.col("x.key") == F.col("y.key")
    if not hot.isEmpty():
        slices = F.coalesce("slices", F.lit(1))
        vocabulary = vocabulary.join(hot, "key", "left").withColumn("slice", F.pmod(F.xxhash64("word"), slices).cast("int"))
        keys = keys.join(hot, "key", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        on = on & (F.col("x.slice") == F.col("y.slice"))
    a, b = F.col("x.word"), F.col("y.word")
    first = (F.length(a) > F.length(b)) | ((F.length(a) == F.length(b)) & ((reduced(a) < reduced(b)) | ((reduced(a) == reduced(b)) & (a < b))))
    out = keys.alias("x").join(vocabulary.hint("merge").alias("y"), on & first & (F.levenshtein(a, b, 1) == 1))
    return out.select(a.alias("a"), F.col("x.n").alias("n_a"), b.alias("b"), F.col("y.n").alias("n_b"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form. A form is at least ten times as frequent, so chains have no circles and their
    length follows the logarithm of the largest count; each round doubles the way gone."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = materialize(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(now)
        if out.where("moved").isEmpty():
            return out.select("word", "root")
        now = out


def spelling_variants(docs: DataFrame, min_letters: int = 7, min_count: int = 2, times: int = 10, symbols: int = SYMBOLS, cell: int = CELL,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of word_counts().

    form: the near word (one edit away) of largest n, the first by code points on ties, if that n is at least `times`
    the word's; root: where following forms ends. Null texts have no words; rows with a null id count as of the empty
    id, repeated rows as often as they stand there; words of any length are compared whole; no words, no rows.
    """
    arrow_batches(docs.sparkSession)
    if times < 2:
        raise ValueError("times must be at least 2, or forms could run in circles")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = materialize(word_counts(d, min_letters, min_count))
    pairs = near_pairs(words, symbols, cell)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")))).alias("p"))
    near = both.groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.m")).alias("m"), F.col("p.near").alias("near"))).alias("best"))
    near = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("m"))
    is_form: Column = F.coalesce(F.col("m") >= times * F.col("n"), F.lit(False))
    out = materialize(near.select("word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("m")).alias("form_n")))
    release(words)
    roots = _roots(out.where("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

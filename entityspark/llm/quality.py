"""Document quality: base rules and a hashed n-gram likelihood ratio, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityspark.llm.common import SPACE, SPACES, hinted
from entityspark.storage import materialize

SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_words(docs: DataFrame) -> DataFrame:
    """Adds words, n_words and word_ids (64-bit hashes of the words)."""
    d = docs.withColumn("words", words_of(F.col("text")))
    return d.withColumn("word_ids", F.transform("words", lambda w: F.xxhash64(w))).withColumn("n_words", F.size("words").cast("long"))


def features(ids: str, buckets: int) -> Column:
    """The bucket of every word and of every pair of neighbouring words."""
    pairs = F.expr(f"transform(if(size({ids}) > 1, sequence(0, size({ids}) - 2), array()), i -> cast(pmod(xxhash64({ids}[i], {ids}[i + 1]), {buckets}) as int))")
    return F.concat(F.transform(ids, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def repeated_words(d: DataFrame, ids: str = "word_ids") -> DataFrame:
    """Adds n_repeat_words: words that lie in a three-word window found twice or more in the text.

    Part of a window's hash and its place share one integer, as many low bits as the places need, so sorting plain
    integers brings equal windows together. In long texts few bits of hash remain, so the places that this leaves are
    sorted again by their words' ids, which decide; the covered words are then summed over the places in order.
    """
    d = d.withColumn("b", F.expr(f"length(bin(size({ids})))"))
    d = d.withColumn("w", F.expr(f"""sort_array(transform(if(size({ids}) > 2, sequence(0, size({ids}) - 3), array()),
        i -> shiftleft(xxhash64({ids}[i], {ids}[i + 1], {ids}[i + 2]), b) | cast(i as bigint)))"""))
    d = d.withColumn("w", F.expr("""transform(filter(w, (x, j) -> coalesce(shiftright(get(w, j - 1), b) = shiftright(x, b), false)
        or coalesce(shiftright(get(w, j + 1), b) = shiftright(x, b), false)), x -> cast(x & (shiftleft(1L, b) - 1) as int))"""))
    d = d.withColumn("w", F.expr(f"sort_array(transform(w, i -> named_struct('ids', named_struct('a', {ids}[i], 'b', {ids}[i + 1], 'c', {ids}[i + 2]), 'i', cast(i as bigint))))"))
    d = d.withColumn("w", F.expr("sort_array(transform(filter(w, (x, j) -> coalesce(get(w, j - 1).ids = x.ids, false) or coalesce(get(w, j + 1).ids = x.ids, false)), x -> x.i))"))
    total = """aggregate(w, named_struct('n', 0L, 'last', 0L),
        (a, x) -> named_struct('n', a.n + 3L - greatest(0L, a.last - x), 'last', x + 3L), a -> a.n)"""
    return d.withColumn("n_repeat_words", F.expr(total)).drop("b", "w")


def base_columns(d: DataFrame) -> DataFrame:
    """Adds word_chars, n_symbols and n_dup_lines to a frame with text."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    d = d.withColumn("lines", lines)
    return (d.withColumn("word_chars", F.length(F.translate(text, SPACES, "")).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """One row with an array: per bucket the log of its smoothed share in trusted documents over that in all documents.

    Counts run over all rows and combine per bucket before any shuffle; the result has a fixed size of buckets doubles.
    """
    def counted(d: DataFrame, name: str) -> DataFrame:
        feats = d.withColumn("word_ids", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))
        return feats.select(F.explode(features("word_ids", buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))

    raw, target = counted(docs, "raw"), counted(docs.join(hinted(materialize(trusted)), "doc_id", "left_semi"), "target")
    both = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(raw, "bucket", "left").join(target, "bucket", "left").na.fill(0)
    arrays = both.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    ratio = F.transform("c", lambda x: F.log((x["target"] + 1) / (F.col("n_target") + buckets)) - F.log((x["raw"] + 1) / (F.col("n_raw") + buckets)))
    return arrays.select(ratio.alias("ratios"))


def label_threshold(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with threshold: where the llr parts documents labelled 1 from those labelled 0 with the least sum of both
    classes' shares on the wrong side, in steps of 0.001, midway to the next document below; the lowest of equally good
    places. Documents that fail the base rules don't count. Null where a class has no document."""
    found = scored.where("not base_failed").join(labels, "doc_id")
    bins = found.groupBy(F.round("llr", 3).alias("bin")).agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
    # at most some tens of thousands of bins, as a mean of log ratios of counts lies within a few dozen of 0
    below, all_bins = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    lost = F.coalesce(F.sum("good").over(below), F.lit(0)) / F.nullif(F.sum("good").over(all_bins), F.lit(0))
    bad = F.sum("bad").over(all_bins)
    passed = (bad - F.coalesce(F.sum("bad").over(below), F.lit(0))) / F.nullif(bad, F.lit(0))
    places = bins.select(((F.lag("bin").over(Window.orderBy("bin")) + F.col("bin")) / 2).alias("middle"), "bin", (lost + passed).alias("wrong"))
    return places.where("wrong is not null").agg(F.min_by(F.coalesce("middle", "bin"), F.struct("wrong", "bin")).alias("threshold"))


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 15, threshold: float | None = None, min_words: int = 50,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept for every row.

    llr: the mean over a text's words and word pairs of the log-likelihood ratio between the documents labelled with
    quality 1 and all documents; kept: the base rules hold and llr >= threshold. threshold: one number for all documents; None
    takes it from the labels (label_threshold), and where these have one class only the base rules decide. Null text counts as empty and fails
    the base rules with llr 0; repeated rows are judged each; labels repeated or null for a document count once if any
    says 1. Everything of one text
    stays in its row, so a text of any length needs no shuffle; only trusted texts are joined, on doc_id.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    trusted = labels.where("quality = 1").select(F.col(id_col).alias("doc_id")).distinct()
    ratios = log_ratios(d, trusted, buckets)
    d = repeated_words(with_words(base_columns(d))).withColumn("features", features("word_ids", buckets))
    d = docs.sparkSession.sql("SELECT *, (SELECT ratios FROM {r}) AS ratios FROM {d}", r=ratios, d=d)
    d = d.withColumn("llr", F.expr("round(aggregate(features, 0D, (a, x) -> a + coalesce(get(ratios, x), 0D)) / greatest(1, size(features)), 9)"))
    d = d.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    # one generated row each: a filter on the result then can't move below, into the functions over each word
    row = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr")
    scored = d.select("doc_id", F.explode(F.array(row)).alias("q")).select("doc_id", "q.*")
    if threshold is not None:
        return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    scored = materialize(scored)
    said = labels.where("quality in (0, 1)").groupBy(F.col(id_col).alias("doc_id")).agg(F.max("quality").cast("long").alias("quality"))
    found = label_threshold(scored, said)
    scored = docs.sparkSession.sql("SELECT *, (SELECT threshold FROM {t}) AS threshold FROM {s}", t=found, s=scored)
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= F.col("threshold"), F.lit(True))).drop("threshold")

"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityspark.llm.common import arrow_batches, utf8

NGRAMS = (2, 3, 4)
_PIECE = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def gram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the byte n-grams of all rows' words, A-Z folded, other ASCII as space; a space may stand only
    at an n-gram's ends. Works piece by piece, so memory does not follow the text's length."""
    c = _FOLD[data]
    for at in range(0, len(c), _PIECE):
        piece = c[at:at + _PIECE + max(NGRAMS) - 1].astype(np.uint64)
        row = np.searchsorted(offsets, np.arange(at, at + len(piece)), "right") - 1
        space = piece == 32
        for n in NGRAMS:
            m = min(_PIECE, len(piece) - n + 1)
            if m <= 0:
                continue
            key = np.full(m, n, np.uint64)
            for j in range(n):
                key = key * np.uint64(257) + piece[j:j + m]
            ok = row[:m] == row[n - 1:n - 1 + m]
            for j in range(1, n - 1):
                ok &= ~space[j:j + m]
            ok &= ~(space[:m] & space[n - 1:n - 1 + m])
            key = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            yield row[:m][ok], (key[ok] % np.uint64(buckets)).astype(np.int64)


@dataclass
class Model:
    """table: log-odds of each bucket and language (embeddings times output weights), so a text's logits are the mean
    of its rows; temperature and reject_below come from texts that the fit did not see."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(offsets) - 1, len(self.langs)
        total, count = np.zeros((n, k)), np.zeros(n)
        for row, bucket in gram_buckets(data, offsets, len(self.table)):
            if len(row):
                low = int(row[0])
                here = int(row[-1]) - low + 1
                count[low:low + here] += np.bincount(row - low, minlength=here)
                for j in range(k):
                    total[low:low + here, j] += np.bincount(row - low, self.table[bucket, j], here)
        p = softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)
        return p.argmax(1), p.max(1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: list[str], buckets: int, dim: int = 16,
        epochs: int = 10, rate: float = 0.5, precision: float = 0.995, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, shares) rows; every fifth row is held back for the temperature and for
    the lowest score at which the given share of answers is right."""
    rng, k = np.random.default_rng(seed), len(langs)
    emb, out, bias = rng.normal(0, 0.1, (buckets, dim)), rng.normal(0, 0.1, (dim, k)), np.zeros(k)
    rows = rng.permutation(len(x))
    held, train = (rows[::5], np.setdiff1d(rows, rows[::5])) if len(x) >= 50 else (rows, rows)

    def dense(which: np.ndarray) -> np.ndarray:
        m = np.zeros((len(which), buckets), np.float32)
        for i, j in enumerate(which):
            m[i, x[j][0]] = x[j][1]
        return m

    scale = 1 / np.median([np.sqrt((v * v).sum()) for _, v in x])  # rows of about unit length; folded into the table below
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(train)
        for at in range(0, len(train), 32):
            batch = train[at:at + 32]
            m = scale * dense(batch)
            hidden = m @ emb
            grad = softmax(hidden @ out + bias)
            grad[np.arange(len(batch)), y[batch]] -= 1
            grad /= len(batch)
            back = m.T @ (grad @ out.T)
            out -= step * hidden.T @ grad
            bias -= 0.1 * step * grad.sum(0)
            emb -= step * back
    table = (scale * emb @ out).astype(np.float32)
    logits = np.concatenate([dense(held[a:a + 256]) @ table + bias for a in range(0, len(held), 256)])
    scales = np.geomspace(0.05, 20, 121)
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in scales]
    t = float(scales[int(np.argmin(losses))])
    p = softmax(logits / t)
    score, right = p.max(1), p.argmax(1) == y[held]
    order = np.argsort(score)
    share = np.cumsum(right[order][::-1])[::-1] / np.arange(len(order), 0, -1)
    fine = np.flatnonzero(share >= precision)
    return Model(langs, table, bias, t, float(min(0.9, score[order][fine[0]] if len(fine) and fine[0] else 1.0 / max(k, 1))))


def train_language_model(docs: DataFrame, train: Column, per_lang: int = 500, buckets: int = 1 << 13) -> Model | None:
    """Fit on about per_lang documents of each language among rows where train holds and lang and text are not null.

    The sample is the documented bound: rows whose hash of doc_id falls below a share set by the language's count, so
    neither the driver's memory nor its time grows with the corpus. Each sampled document gives its whole text and up
    to four windows of 48 bytes, which teach short texts. None if there is nothing to learn from.
    """
    arrow_batches(docs.sparkSession)
    known = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_lang / n)).otherwise(share)
    sample = known.where((F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            langs, idx, cnt = [], [], []
            for i, lang in enumerate(batch.column(0).to_pylist()):
                text = data[offsets[i]:offsets[i + 1]]
                views = [text] + [text[a:a + 48] for a in np.linspace(0, max(0, len(text) - 48), 4).astype(int)] * (len(text) > 96)
                for view in views:
                    got = [b for _, b in gram_buckets(view, np.array([0, len(view)]), buckets)]
                    if got and sum(map(len, got)):
                        which, n = np.unique(np.concatenate(got), return_counts=True)
                        langs.append(lang)
                        idx.append(which.astype(np.int32).tobytes())
                        cnt.append((n / n.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(idx, pa.binary()), pa.array(cnt, pa.binary())], ["lang", "idx", "cnt"])

    rows = sample.mapInArrow(count, "lang string, idx binary, cnt binary").toPandas().sort_values(["lang", "idx", "cnt"])
    if rows.empty:
        return None
    langs = sorted(counts)
    y = rows["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy()
    x = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b in zip(rows["idx"], rows["cnt"])]
    return fit(x, y, langs, buckets)


def identify_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of docs with lang_pred, score and rejected.

    Every whole text is read in one narrow pass, only text decides. Null, empty and letterless texts, and all texts if
    there is no model: `und`, score 0, rejected. Other texts get a learned language; rejected where the calibrated
    score is below the model's bound. Columns of these names in docs are replaced; repeated rows are judged each.
    """
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            text = batch.column(names.index("text"))
            lang, score = ["und"] * len(text), np.zeros(len(text))
            if m is not None and len(text):
                best, p = m.predict(*utf8(text))
                for i, t in enumerate(text.to_pylist()):
                    if t and _LETTER.search(t):
                        lang[i], score[i] = m.langs[best[i]], min(1.0, p[i])
            bad = [a == "und" or s < m.reject_below for a, s in zip(lang, score)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(bad, pa.bool_())],
                                             [*names, "lang_pred", "score", "rejected"])

    d = docs.select(*names)
    schema = T.StructType([*d.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return d.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """One third of the documents, by the checksum of their id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))

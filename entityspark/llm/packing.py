"""Sequence packing by lexical retrieval: BM25 neighbours of a seed fill its window."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import PairMerger, arrow_batches, docs_of
from entityspark.storage import materialize

#: The tokenizer's units in lower-cased text, for the characters below (tested against the library).
_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_OTHER = re.compile("[^\t\n\r\x20-\x7e¡-±´-¸º»¿-įı-ɏ‐-‧€]")
_PLAIN = bytes([9, 10, 13, *range(32, 127)])
_CACHE, _LONG, _GROUP = 400_000, 48, 1 << 20
K1, B = 1.2, 0.75
#: Tokens of a task's range and of one index within it.
TASK_TOKENS, INDEX_TOKENS = 2 << 20, 1 << 18


class WordEncoder(dict):
    """Ids of whole texts as raw integers of dtype, for a tokenizer that drops white space and marks the ends of its
    units: the ids of a string between white space, by the string. One met first is cut into units, whose merges never
    reach each other. Texts with special strings or characters outside the list above go to the library whole. The
    cache is bounded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tok = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.ids = PairMerger(self.tok).ids

    def __missing__(self, word: str) -> bytes:
        units = [word] if word.isalpha() else _UNITS.findall(word)
        raw = np.array([i for u in units for i in self.ids(u)], self.dtype).tobytes()
        if len(word) < _LONG:
            if len(self) > _CACHE:
                self.clear()
            self[word] = raw
        return raw

    def encode(self, text: str) -> bytes:
        known = not text.encode().translate(None, _PLAIN) if text.isascii() else not _OTHER.search(text)
        if not known or any(s in text for s in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    """One per worker process, so that later tasks find it filled."""
    return WordEncoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """doc_id, start, doc_tokens, n, ids: every document's ids with the end id, cut at multiples of window. ids holds
    little-endian integers of as many bytes as the vocabulary needs."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        width = np.dtype(encoder.dtype).itemsize
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            keys, starts, totals, sizes, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                flat = encoder.encode(text or "") + end
                for at in range(0, len(flat), width * window):
                    piece = flat[at:at + width * window]
                    keys.append(i)
                    starts.append(at // width)
                    totals.append(len(flat) // width)
                    sizes.append(len(piece) // width)
                    ids.append(piece)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), pa.array(starts, pa.int64()), pa.array(totals, pa.int64()),
                                              pa.array(sizes, pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "start", "doc_tokens", "n", "ids"])

    return docs.mapInArrow(encode, f"doc_id {kind}, start long, doc_tokens long, n int, ids binary")


def term_pairs(ids: list[bytes], dtype: str, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the distinct terms of every row, in order, and the rows' lengths."""
    sizes = np.array([len(x) // np.dtype(dtype).itemsize for x in ids], np.int64)
    row = np.repeat(np.arange(len(ids), dtype=np.uint64), sizes)
    pair = row * np.uint64(vocabulary) + np.frombuffer(b"".join(ids), dtype)
    pair = pair.astype(np.uint32) if len(ids) * vocabulary < 1 << 32 else pair  # sorts twice as fast
    pair.sort()
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    row, term = np.divmod(pair[first].astype(np.int64), vocabulary)
    return row, term, np.diff(np.append(first, len(pair))), sizes


class Statistics:
    """BM25 over all pieces: how many there are, their mean length, and in how many each term stands. A term in more
    than half of them has no weight, as its odds say nothing."""

    def __init__(self, n: int, tokens: int, df: np.ndarray):
        self.n, self.df, self.mean = n, df, max(1.0, tokens / max(1, n))
        self.idf = np.maximum(0.0, np.log((n - df + 0.5) / (df + 0.5))).astype(np.float32)

    def weights(self, term: np.ndarray, times: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.idf[term] * (times * np.float32(K1 + 1) / (times + K1 * (1 - B + B / self.mean * size)).astype(np.float32))


def statistics(pieces: DataFrame, dtype: str, vocabulary: int) -> Statistics:
    """Counts over all pieces; what reaches the driver is one number per entry of the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            _, term, _, sizes = term_pairs(ids, dtype, vocabulary)
            df += np.bincount(term, minlength=vocabulary)
            n, tokens = n + len(ids), tokens + int(sizes.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[n, tokens], df[some]]))], ["term", "c"])

    found = pieces.select("ids").mapInArrow(count, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).toPandas()
    all_ = dict(zip(found["term"].tolist(), found["c"].tolist()))
    df = np.zeros(vocabulary)
    some = found[found["term"] >= 0]
    df[some["term"].to_numpy()] = some["c"].to_numpy()
    return Statistics(all_.get(-2, 0), all_.get(-1, 0), df)


class Index:
    """BM25 over the items of one shard by the statistics of all: postings of each term, weights ready."""

    def __init__(self, items: list[bytes], dtype: str, stats: Statistics):
        row, term, times, sizes = term_pairs(items, dtype, len(stats.idf))
        use = stats.idf[term] > 0
        row, term, times = row[use], term[use], times[use]
        self.n, self.place = len(items), np.searchsorted(row, np.arange(len(items) + 1))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = row[order], stats.weights(term, times, sizes[row])[order]
        known, self.first, df = np.unique(term[order], return_index=True, return_counts=True)
        self.df, self.slot = df, np.searchsorted(known, term)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused items that share a weighted term with the seed, best first, ties by place. The query is all terms of
        the seed."""
        slots = self.slot[self.place[seed]:self.place[seed + 1]]
        size = self.df[slots]
        at = np.arange(size.sum()) + np.repeat(self.first[slots] - np.cumsum(size) + size, size)
        score = np.bincount(self.doc[at], self.weight[at], self.n) * unused
        hit = np.flatnonzero(score > 0)
        return hit[np.lexsort((hit, -score[hit].round(6)))]


def pack_shard(sizes: list[int], index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """(item, from, length, sequence, offset) of every piece, for items below the window size.

    The first unused item seeds a sequence, its BM25 neighbours follow until the window is full; without any, the
    next unused item does. What does not fit of the last one stays unused. The rest that no longer fills a window is
    cut at powers of two, so no sequence needs padding.
    """
    left, done = np.array(sizes, np.int64), np.zeros(len(sizes), np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    total, seq, cursor = int(left.sum()), 0, 0
    while total:
        room = window if total >= window else 1 << (total.bit_length() - 1)
        total -= room
        while not left[cursor]:
            cursor += 1
        queue, offset, scored = [cursor], 0, False
        following = cursor
        while room:
            if not queue:
                if not scored:
                    queue, scored = index.neighbours(cursor, left > 0).tolist()[::-1], True
                    continue
                while not left[following]:
                    following += 1
                queue = [following]
            item = queue.pop()
            take = min(int(left[item]), room)
            if not take:
                continue
            out.append((item, int(done[item]), take, seq, offset))
            done[item] += take
            left[item] -= take
            room -= take
            offset += take
        seq += 1
    return out


def key_terms(pieces: DataFrame, dtype: str, stats: Statistics) -> DataFrame:
    """Adds k1, k2, k3: a piece's three heaviest terms among those that another piece has too (-1 without), heaviest
    first, ties by term. Pieces that are each other's neighbours share heavy terms and so sort side by side."""
    shared = pieces.sparkSession.sparkContext.broadcast(stats)
    names = [c for c in pieces.columns if c not in ("k1", "k2", "k3")]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            row, term, times, sizes = term_pairs(batch.column(names.index("ids")).to_pylist(), dtype, len(s.idf))
            use = (s.df[term] > 1) & (s.idf[term] > 0)
            row, term = row[use], term[use]
            weight = s.weights(term, times[use], sizes[row])
            got = np.full((3, len(batch)), -1, np.int32)
            for k in range(3):
                first = np.searchsorted(row, np.arange(len(batch)))
                some = np.flatnonzero(np.append(first[1:], len(row)) > first)
                if not len(some):
                    break
                top = np.maximum.reduceat(weight, first[some])
                best = np.flatnonzero(weight == np.repeat(top, np.diff(np.append(first[some], len(row)))))
                best = best[np.unique(row[best], return_index=True)[1]]
                got[k, row[best]] = term[best]
                weight[best] = -1
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in got)], [*names, "k1", "k2", "k3"])

    kinds = dict(pieces.dtypes)
    return pieces.select(*names).mapInArrow(keys, ", ".join(f"{c} {kinds[c]}" for c in names) + ", k1 int, k2 int, k3 int")


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, task_tokens: int = TASK_TOKENS, index_tokens: int = INDEX_TOKENS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's tokens in sequences of at most window tokens: doc_id, start, length, doc_tokens, sequence_id,
    offset, ids (unsigned 32-bit little-endian).

    Documents are cut into pieces of at most a window where they are read. A whole window is a sequence and moves no
    further. The others are sorted by their heaviest BM25 terms, by statistics over all pieces, and dealt in ranges of
    about task_tokens tokens, so what is alike comes to one task; a range is worked off in shards of index_tokens, each
    with its own inverted index, and every seed draws its unused neighbours from its shard by all its terms. Tasks and
    shards are bounded by tokens whatever the corpus size, and a term that fills several ranges is parted by the next.

    A sequence holds window tokens or a power of two, so none needs padding. Null text counts as empty (its end id
    alone), repeated rows are packed each, a null id is kept, an empty table gives no rows.
    """
    d = docs_of(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    encoder = word_encoder(tokenizer)
    dtype, vocabulary = encoder.dtype, encoder.tok.get_vocab_size()
    cut = materialize(token_pieces(d, tokenizer, window, end_id))
    part = cut.where(F.col("n") < window)
    stats = statistics(part, dtype, vocabulary)
    if not stats.n:
        stats = Statistics(0, 0, np.zeros(vocabulary))
    keyed = materialize(key_terms(part, dtype, stats))
    whole = cut.where(F.col("n") == window)
    tasks = max(1, -(-int(stats.mean * stats.n) // task_tokens))
    order = ["k1", "k2", "k3", "doc_id", "start", "ids"]
    dealt = keyed.repartitionByRange(tasks, *order[:5]).sortWithinPartitions(*order)
    shared = docs.sparkSession.sparkContext.broadcast(stats)
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    columns = ["doc_id", "start", "doc_tokens", "ids"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, tokens = [], 0
        for batch in batches:
            size = np.cumsum(batch.column("n").to_numpy())
            at = 0
            while at < len(batch):
                end = int(np.searchsorted(size, size[at - 1] * (at > 0) + index_tokens - tokens)) + 1
                held.append(batch.slice(at, end - at))
                tokens += int(size[min(end, len(batch)) - 1] - size[at - 1] * (at > 0))
                at = end
                if tokens >= index_tokens:
                    yield pa.Table.from_batches(held)
                    held, tokens = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def wide(ids: bytes) -> bytes:
        return np.frombuffer(ids, dtype).astype("<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for table in shards(batches):
            raw = table.column("ids").to_pylist()
            plan = pack_shard(table.column("n").to_pylist(), Index(raw, dtype, shared.value), window)
            item, at, size, seq, off = (np.array(x, np.int64) for x in zip(*plan))
            width = np.dtype(dtype).itemsize
            ids = [wide(raw[i][width * a:width * (a + n)]) for i, a, n in zip(item, at, size)]
            out = pa.table({"doc_id": table.column("doc_id").take(pa.array(item)), "start": pa.array(table.column("start").to_numpy()[item] + at), "length": pa.array(size),
                            "doc_tokens": table.column("doc_tokens").take(pa.array(item)), "sequence_id": pa.array(2 * (first + seq) + 1), "offset": pa.array(off), "ids": pa.array(ids, pa.binary())})
            first += int(seq[-1]) + 1
            yield from out.to_batches()

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(n, window, np.int64)), batch.column(2), pa.array(2 * (first + np.arange(n, dtype=np.int64))),
                                              pa.array(np.zeros(n, np.int64)), pa.array([wide(x) for x in batch.column(3).to_pylist()], pa.binary())], names)
            first += n

    return dealt.select(*columns, "n").mapInArrow(pack, schema).unionAll(whole.select(*columns).mapInArrow(alone, schema))

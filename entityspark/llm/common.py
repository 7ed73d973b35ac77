"""What the operators of this subpackage share: column handling, Arrow batches and hashing of words in raw bytes."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
#: The white space that separates words, as a class for Java and Python patterns.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_CHUNK = 1 << 20
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = 0x9E3779B97F4A7C15 | 1


def arrow_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the bytes of the batches that go to Python, so that long texts do not add up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def docs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names, so that no other column of the caller can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def hinted(keys: DataFrame, most: int = 1_000_000, most_bytes: int = 64 << 20) -> DataFrame:
    """Written keys for the small side of a join: broadcast if counted to be at most so many and, by the size of their
    files, so many bytes; else merged."""
    size = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return keys.hint("broadcast" if size <= most_bytes and keys.count() <= most else "merge")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if column.null_count and (sizes := np.diff(offsets))[~np.asarray(column.is_valid())].any():
        keep = np.asarray(column.is_valid())
        data, offsets = data[np.repeat(keep, sizes)], np.concatenate([[0], np.cumsum(sizes * keep)])
    return data, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows, A-Z in lower case, and the offset of each row's first word.
    Words never cross rows. Worked off in pieces that end between words, so memory stays with the piece."""
    n, found, starts_all = len(data), [], []
    powers = np.ones(0, np.uint64)
    at = 0
    while at < n:
        end = min(at + _CHUNK, n)
        while end < n and not _IS_SPACE[data[end]]:  # to the end of the word
            gap = np.flatnonzero(_IS_SPACE[data[end:end + 4096]])
            end = min(n, end + (int(gap[0]) if len(gap) else 4096))
        b = data[at:end]
        inside = ~_IS_SPACE[b]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        first = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        begin[first] = inside[first]
        starts = np.flatnonzero(begin)
        if len(starts):
            place = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b)))) if starts[0] == 0 else \
                np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))])
            most = int(place.max()) + 1
            if len(powers) < most:
                powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(most, _P, np.uint64)]), dtype=np.uint64)
            found.append(mix(np.add.reduceat(_BYTE[b] * powers[place] * inside, starts)))
            starts_all.append(starts + at)
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts_all), offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words of one row; of the whole row if it has fewer words; none without words."""
    k = min(k, len(words))
    if not k:
        return words
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[i:len(words) - k + 1 + i])
    return out


class PairMerger:
    """Ids of one unit (pre-token) by the pair merges of a byte-level vocabulary file, as its library gives them.

    The merges run in the other installed tokenizer library, several times as fast for a single short unit: it merges
    by the ids of the results, which is the same where the file's merges come in the order of these ids (checked here).
    A vocabulary with marked word ends writes the mark as byte 255, which no UTF-8 text holds and which the ids join to
    the last byte first. The few strings of the vocabulary that the merges don't reach keep the ids of the file's library.
    """

    def __init__(self, tok):
        import tiktoken

        model = json.loads(tok.to_str())["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if made != sorted(made) or model.get("continuing_subword_prefix"):
            raise ValueError("the merges of this vocabulary are not in the order of its ids")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t.content for t in tok.get_added_tokens_decoder().values()}
        self.end = b"\xff" if suffix else b""

        def raw(token: str) -> bytes:
            ends = bool(suffix) and token.endswith(suffix)
            return bytes(byte[c] for c in (token[:-len(suffix)] if ends else token)) + (self.end if ends else b"")

        ranks = {raw(t): i for t, i in vocab.items() if t not in special}
        self.merge = tiktoken.Encoding("pairs", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        units = []
        for t in ranks:
            if t.endswith(self.end):
                try:
                    units.append(t[:len(t) - len(self.end)].decode())
                except UnicodeDecodeError:
                    pass
        self.odd = {}
        for unit, e in zip(units, tok.encode_batch_fast(units, add_special_tokens=False)):
            if len(e.ids) > 1 and "".join(tok.decoder.decode([t]) for t in e.tokens).strip() == unit.strip():
                self.odd[unit] = e.ids

    def ids(self, unit: str) -> list[int]:
        return self.odd.get(unit) or self.merge(unit.encode() + self.end)

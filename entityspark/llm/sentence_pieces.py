"""SentencePiece encoding and decoding: merges per unit, or a max-plus scan over chunks of giant documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import arrow_batches, docs_of
from entityspark.storage import materialize

MARK = "▁"
NONE = -(1 << 61)
_UNKNOWN = 10.0
_CACHE = 200_000


class Pieces:
    """The pieces and scores of a model file, as a lattice: a text's encoding is its path with the largest sum.

    Weights are integers: the score in steps of 1/1024, and below that a number drawn from the piece and its place in
    its unit (a run of marks and what follows), which parts paths of equal score, so that chunks choose the same path
    as a whole text would. Characters without a piece cost ten below the worst score and stand as byte pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        # some files give rare pieces -1e9; one below the worst real score says as much and keeps sums small
        worst = min((sp.get_score(i) for i in plain if sp.get_score(i) > -1e6), default=0.0) - 1
        self.names = [sp.id_to_piece(i) for i in ids]
        self.byte_ids = {int(self.names[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.control = {i for i in ids if sp.is_control(i)}
        self.raw = [bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if i in self.control else self.names[i].replace(MARK, " ").encode() for i in ids]
        self.weight = {self.names[i]: (self._weigh(max(worst, sp.get_score(i))), i) for i in plain}
        self.lowest = self._weigh(worst - _UNKNOWN)
        self.longest = max(len(self.names[i]) for i in plain)
        # whether every path passes each place where a mark follows another character
        self.parted = not any(MARK in self.names[i].lstrip(MARK) for i in plain)
        self.cache: dict[str, tuple[int, bytes]] = {}
        self.mark = re.compile(f"(?<!{MARK}){MARK}")
        self.unit = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S)

    @staticmethod
    def _weigh(score: float) -> int:
        return round(score * 1024) << 18

    def arcs(self, text: str, at: int, end: int, base: int) -> list[tuple[int, int, int]]:
        """(next place, weight, id or -1) of what may start at a place; base: where its unit begins."""
        found, place = [], (at - base + 1) * 0x9E3779B1
        for n in range(1, min(self.longest, end - at) + 1):
            hit = self.weight.get(text[at:at + n])
            if hit:
                found.append((at + n, hit[0] + ((place ^ hit[1] * 0x85EBCA77) * 0xC2B2AE35 >> 11 & 0xFFFF), hit[1]))
        if not found or found[0][0] != at + 1:
            found.append((at + 1, self.lowest, -1))
        return found

    def forward(self, text: str, a: int, b: int, low: int, base: int) -> tuple[list[int], list]:
        """Best weight and last piece of every place from a to b, by pieces that start below low."""
        score, back = [NONE] * (b - a + 1), [None] * (b - a + 1)
        score[0] = 0
        for at in range(a, min(low, b)):
            here = score[at - a]
            if here != NONE:
                for to, w, i in self.arcs(text, at, b, base):
                    if here + w > score[to - a]:
                        score[to - a], back[to - a] = here + w, (at, i)
        return score, back

    def backward(self, text: str, b: int, base: int) -> list[int]:
        """Best weight from every place up to b."""
        score = [NONE] * b + [0]
        for at in range(b - 1, -1, -1):
            score[at] = max(w + score[to] for to, w, _ in self.arcs(text, at, b, base))
        return score

    def best(self, text: str, a: int, b: int, low: int, base: int) -> tuple[int, bytes]:
        """Weight and ids of the best path from a to b, all of whose pieces start below low."""
        score, back = self.forward(text, a, b, low, base)
        ids, at = [], b
        while at > a:
            before, i = back[at - a]
            ids.append([i] if i >= 0 else [self.byte_ids[x] for x in text[before:at].encode()])
            at = before
        return score[b - a], np.array([i for some in reversed(ids) for i in some], "<u4").tobytes()

    def cached(self, unit: str) -> tuple[int, bytes]:
        got = self.cache.get(unit)
        if got is None:
            got = self.best(unit, 0, len(unit), len(unit), 0)
            if len(unit) <= 64:
                if len(self.cache) > _CACHE:
                    self.cache.clear()
                self.cache[unit] = got
        return got

    def since(self, text: str, at: int) -> int:
        """Characters from the start of a place's unit to the place."""
        if not self.parted:
            return at
        begin = text.rfind(MARK, 0, at + 1)
        while begin > 0 and text[begin - 1] == MARK:
            begin -= 1
        return at - max(begin, 0)

    def cuts(self, text: str, body: int, since: int) -> tuple[int, int] | None:
        """The first and last start of a unit in a chunk's body, which every path passes, if there is one."""
        found = self.parted and self.mark.search(text, min(since, 1), body)
        if not found:
            return None
        last = text.rfind(MARK, 0, body)
        while last > found.start() and text[last - 1] == MARK:
            last -= 1
        return found.start(), last

    def transfer(self, text: str, body: int, since: int) -> np.ndarray:
        """T[i, j]: the best weight from i places into a chunk of body characters to j places beyond it, by pieces that
        start in it. text holds what follows the body too, since tells how far in its unit text[0] stands."""
        k = self.longest
        out = np.full((k, k), NONE, np.int64)
        reach = min(k, len(text) - body + 1)
        span = self.cuts(text, body, since)
        if span:
            a, z = span
            head = np.full(k, NONE)
            head[:a + 1] = self.backward(text, a, -since)[:k]
            middle = sum(self.cached(u)[0] for u in self.unit.findall(text[a:z]))
            tail = np.array(self.forward(text, z, body + reach - 1, body, z)[0][body - z:])
            out[:, :reach] = np.where((head[:, None] > NONE // 2) & (tail[None] > NONE // 2), head[:, None] + middle + tail[None], NONE)
            return out
        f = np.full((body + k, k), NONE, np.int64)
        f[np.arange(k), np.arange(k)] = 0  # also those that pass over a chunk shorter than a piece
        for at in range(body):
            for to, w, _ in self.arcs(text, at, min(len(text), body + k - 1), -since):
                np.maximum(f[to], np.where(f[at] > NONE // 2, f[at] + w, NONE), out=f[to])
        out[:, :reach] = f[body:body + reach].T
        return out

    def path(self, text: str, body: int, a: int, j: int, since: int) -> bytes:
        """Ids of the best path of a chunk from entry a to exit j."""
        end = body + j
        if a >= end:
            return b""
        span = self.cuts(text, body, since)
        if span and span[0] >= a:
            q, z = span
            return self.best(text, a, q, q, -since)[1] + b"".join(self.cached(u)[1] for u in self.unit.findall(text[q:z])) + self.best(text, z, end, body, z)[1]
        return self.best(text, a, end, body, -since)[1]

    def whole(self, text: str) -> bytes:
        if self.parted:
            return b"".join(self.cached(u)[1] for u in self.unit.findall(text))
        return self.best(text, 0, len(text), len(text), 0)[1]

    def decode(self, ids: np.ndarray, first: bool) -> str:
        out = b"".join(map(self.raw.__getitem__, ids.tolist()))
        text = out.decode("utf-8", "replace")
        return text[1:] if first and text.startswith(" ") else text


class Merges:
    """Ids of a merge model as the library gives them. If no piece holds a mark behind another character, no merge
    crosses the start of a unit, so units are encoded by the library once, many in one call, and looked up after that;
    else texts are encoded whole. The cache is bounded."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        # units as the library would see them alone: neither rewritten nor without the mark in front
        plain = self.sp.encode("  a  \u00bd", out_type=str) == self.sp.encode(f"{MARK * 2}a{MARK * 2}\u00bd", out_type=str) and self.sp.decode(self.sp.encode("  a  \u00bd")) == "  a  \u00bd"
        self.parted = plain and MARK in names and not any(MARK in n.lstrip(MARK) for n in names)
        self.unit = re.compile(f"{MARK}+[^{MARK}]*")
        self.start = re.compile(f"(?<![ {MARK}])[ {MARK}]")
        self.cache = {MARK: np.array([names.index(MARK)], "<u4").tobytes()} if self.parted else {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.sp.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose spaces are marks, one in front."""
        if not self.parted:
            return self._library([t[1:] for t in texts])
        units = [self.unit.findall(t) for t in texts]
        if len(self.cache) > _CACHE:
            self.cache = {MARK: self.cache[MARK]}
        new = [u for u in set().union(*units) if u not in self.cache]
        fresh = dict(zip(new, self._library([u[1:] for u in new])))  # the library puts the first mark back
        self.cache |= {u: i for u, i in fresh.items() if len(u) <= 64}
        return [b"".join([fresh[u] if u in fresh else self.cache[u] for u in found]) for found in units]

    def chunks(self, text: str, size: int) -> list[str]:
        """A text in parts of about so many characters that start where a unit does; a longer unit is one part."""
        if not self.parted:
            return [text]
        starts, at = [0], size
        while (found := self.start.search(text, max(at, 1))):
            starts.append(found.start())
            at = found.start() + size
        return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


@lru_cache(1)
def merges(path: str) -> Merges:
    """One per worker process, so that later tasks find it filled."""
    return Merges(path)


def is_merge_model(path: str) -> bool:
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
    return proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product: the transfer matrix of two neighbouring chunks."""
    out = np.maximum((left[:, :, None] + right[None]).max(1), NONE)
    return np.where(out > NONE // 2, out - out.max(), NONE)  # only differences matter; sums stay small


def boundary_states(matrices: np.ndarray) -> list[int]:
    """The place, relative to each chunk's start, at which the best path of the whole text enters it; last: 0.

    Prefix products of all chunks by an associative scan (log2 steps of pairwise products), then from the end each
    entry is the state that best joins the prefix to the chunk.
    """
    n = len(matrices)
    prefix, step = matrices.copy(), 1
    while step < n:
        new = prefix.copy()
        for i in range(step, n):
            new[i] = combine(prefix[i - step], prefix[i])
        prefix, step = new, 2 * step
    states = [0] * (n + 1)
    for c in range(n - 1, 0, -1):
        states[c] = int((prefix[c - 1][0] + matrices[c][:, states[c + 1]]).argmax())
    return states


def encode_pieces(docs: DataFrame, model: str, chunk_chars: int = 16384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row_id, chunk, text, ids: the encoding of every row, by the merges of a merge model, else by the best path
    over the model's pieces.

    Spaces become marks and one mark is put in front, as the library does. Texts up to chunk_chars are one chunk and
    encoded where they are read. With a merge model longer ones are cut where a unit starts, which no merge crosses, and
    their chunks are dealt out; the ids are the library's. With other models longer ones are cut into chunks at any place; each chunk yields its transfer matrix
    between boundary states on its own, the small matrices of a document are combined associatively, and each chunk is
    traced back on its own between the states found. ids: unsigned 32-bit little-endian; text: what they stand for.

    Null text counts as empty: one chunk without ids. Repeated rows are encoded each, row_id tells them apart.
    """
    arrow_batches(docs.sparkSession)
    d = docs_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    kind = d.schema["doc_id"].dataType.simpleString()
    merged = is_merge_model(model)
    longest = 0 if merged else Pieces(model).longest

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield batch, row
            row += len(batch)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(model)
        for batch, row in rows(batches):
            texts = batch.column(1).to_pylist()
            ids = [p.whole(MARK + t.replace(" ", MARK)) if t else b"" for t in texts]
            n = len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(range(row, row + n), pa.int64()), pa.array([0] * n, pa.int32()), batch.column(1), pa.array(ids, pa.binary())],
                                             ["doc_id", "row_id", "chunk", "text", "ids"])

    def merge(texts: list[str], first: list[bool], m: Merges) -> list[bytes]:
        """Ids of chunks: the first of a text gets a mark in front, the others start with one."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):  # some texts at a time, by their size: their units are what memory holds
            end, size = at, 0
            while end < len(texts) and size < 1 << 19:
                size += len(texts[end])
                end += 1
            out += m.encode([(MARK if f else "") + t.replace(" ", MARK) if t else "" for t, f in zip(texts[at:end], first[at:end])])
            at = end
        return out

    def short_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(model)
        for batch, row in rows(batches):
            n = len(batch)
            ids = merge(batch.column(1).to_pylist(), [True] * n, m)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(range(row, row + n), pa.int64()), pa.array([0] * n, pa.int32()), batch.column(1), pa.array(ids, pa.binary())],
                                             ["doc_id", "row_id", "chunk", "text", "ids"])

    def cut_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(model)
        for batch, row in rows(batches):
            for i, text in enumerate(batch.column(1).to_pylist()):
                parts = m.chunks(text, chunk_chars)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(parts))), pa.array([-1 - row - i] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()),
                                                  pa.array(parts, pa.string())], ["doc_id", "row_id", "chunk", "text"])

    def long_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(model)
        for batch in batches:
            ids = merge(batch.column("text").to_pylist(), [c == 0 for c in batch.column("chunk").to_pylist()], m)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(model)
        k = p.longest
        for batch, row in rows(batches):
            for i, text in enumerate(batch.column(1).to_pylist()):
                full = MARK + text.replace(" ", MARK)
                at = list(range(0, len(text), chunk_chars))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(at))), pa.array([-1 - row - i] * len(at), pa.int64()), pa.array(range(len(at)), pa.int32()),
                                                  pa.array([text[a:a + chunk_chars] for a in at], pa.string()), pa.array([text[a + chunk_chars:a + chunk_chars + k] for a in at], pa.string()),
                                                  pa.array([p.since(full, a + 1) if a else 0 for a in at], pa.int32())], ["doc_id", "row_id", "chunk", "text", "after", "since"])

    def prepared(text: str, after: str, chunk: int) -> tuple[str, int]:
        body = (MARK if chunk == 0 else "") + text.replace(" ", MARK)
        return body + after.replace(" ", MARK), len(body)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(model)
        for batch in batches:
            t = [p.transfer(*prepared(x, y, c), s).tobytes() for x, y, c, s in zip(*(batch.column(n).to_pylist() for n in ("text", "after", "chunk", "since")))]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("chunk"), pa.array(t, pa.binary())], ["row_id", "chunk", "matrix"])

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        k = longest
        s = boundary_states(np.stack([np.frombuffer(m, np.int64).reshape(k, k) for m in table.column("matrix").to_pylist()]))
        return pa.table({"row_id": table.column("row_id"), "chunk": table.column("chunk"), "enter": pa.array(s[:-1], pa.int32()), "leave": pa.array(s[1:], pa.int32())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(model)
        for batch in batches:
            cols = (batch.column(n).to_pylist() for n in ("text", "after", "chunk", "enter", "leave", "since"))
            ids = [p.path(*prepared(x, y, c), a, j, s) for x, y, c, a, j, s in zip(*cols)]
            cols = (batch.column(n).to_pylist() for n in ("text", "after", "enter", "leave", "chunk"))
            # in the first chunk, places count the mark in front
            covered = [(x + y)[max(0, a - (c == 0)):len(x) + j] for x, y, a, j, c in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("doc_id", "row_id", "chunk")] + [pa.array(covered, pa.string()), pa.array(ids, pa.binary())], ["doc_id", "row_id", "chunk", "text", "ids"])

    schema = f"doc_id {kind}, row_id long, chunk int, text string, ids binary"
    # written first: rows are numbered in the order of files, which a task that runs again finds unchanged
    giants = materialize(d.where(F.length("text") > chunk_chars))
    if merged:
        one = d.where(F.length("text") <= chunk_chars).mapInArrow(short_merged, schema)
        cut = giants.mapInArrow(cut_merged, f"doc_id {kind}, row_id long, chunk int, text string")
        return one.unionAll(materialize(cut.repartition("row_id", "chunk")).mapInArrow(long_merged, schema))
    one = d.where(F.length("text") <= chunk_chars).mapInArrow(short, schema)
    chunks = giants.mapInArrow(split, f"doc_id {kind}, row_id long, chunk int, text string, after string, since int")
    chunks = materialize(chunks.repartition("row_id", "chunk"))
    found = chunks.mapInArrow(matrices, "row_id long, chunk int, matrix binary").groupBy("row_id").applyInArrow(states, "row_id long, chunk int, enter int, leave int")
    giant = chunks.join(found, ["row_id", "chunk"]).select("doc_id", "row_id", "chunk", "text", "after", "since", "enter", "leave").mapInArrow(trace, schema)
    return one.unionAll(giant)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """All columns with decoded: the text of each chunk's ids. The mark in front of a document's first chunk goes; a
    chunk never ends inside a character, so chunks decode on their own. Null ids: null."""
    arrow_batches(encoded.sparkSession)
    names = [c for c in encoded.columns if c != "decoded"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(model)
        for batch in batches:
            out = [None if i is None else p.decode(np.frombuffer(i, "<u4"), c == 0) for i, c in zip(batch.column(names.index("ids")).to_pylist(), batch.column(names.index("chunk")).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, "decoded"])

    from pyspark.sql import types as T

    d = encoded.select(*names)
    return d.mapInArrow(decode, T.StructType([*d.schema.fields, T.StructField("decoded", T.StringType())]))

"""Removal of repeated passages, found byte-exactly with suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import arrow_batches, hinted, mix, utf8
from entityspark.storage import materialize, release

GRAM = 48
_BYTE = np.random.default_rng(31).integers(1, 1 << 63, 256, dtype=np.uint64)
_P = 0xD1342543DE82EF95
_PIECE, _PLACE = 1 << 20, 21
SHARD_BYTES = 1 << 20


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hashes of all runs of GRAM bytes, by doubling."""
    h, size, kept = _BYTE[b], 1, {}
    while size * 2 <= GRAM:
        kept[size] = h
        h = h[:-size] + h[size:] * np.uint64(pow(_P, size, 1 << 64))
        size *= 2
    rest = GRAM - size
    for part in sorted(kept, reverse=True):
        if rest >= part:
            n = len(h) - part
            h = h[:n] + kept[part][size:size + n] * np.uint64(pow(_P, size, 1 << 64))
            size, rest = size + part, rest - part
    return mix(h)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window, last window, fingerprint): every window of length bytes inside one row belongs to the least
    gram in it (the leftmost of equals), which its content alone decides; runs of windows with the same gram."""
    w = length - GRAM + 1
    for at in range(0, len(data), _PIECE):
        b = data[at:at + _PIECE + length - 1]
        if len(b) < length:
            return
        h = gram_hashes(b)
        low = np.uint64((1 << _PLACE) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(key) // w)
        padded = np.full(blocks * w, np.iinfo(np.uint64).max)
        padded[:len(key)] = key
        padded = padded.reshape(blocks, w)
        before = np.minimum.accumulate(padded, axis=1).ravel()
        after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(b) - length + 1
        least = (np.minimum(after[:n], before[w - 1:w - 1 + n]) & low).astype(np.int64)
        start = np.arange(at, at + n)
        row = np.searchsorted(offsets, start, "right") - 1
        ok = start + length <= offsets[row + 1]
        new = np.ones(n, bool)
        new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n) - 1
        keep = ok[first]
        first, last = first[keep], last[keep]
        yield row[first], first + at - offsets[row[first]], last + at - offsets[row[first]], h[least[first]].view(np.int64)


def suffix_array(b: np.ndarray) -> np.ndarray:
    """Order of all suffixes: Larsson-Sadakane refinement, which sorts only groups still tied and doubles the sorted
    length each time. Kasai's bound needs this full order, so it does not stop at the length looked for."""
    n = len(b)
    padded = np.concatenate([b, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(7):  # seven bytes, then one for texts that end
        key = (key << np.uint64(8)) | padded[i:i + n]
    key = (key << np.uint64(3)) | np.minimum(n - np.arange(n), 7).astype(np.uint64)
    sa = np.argsort(key)
    rank, h = np.empty(n + 1, np.int64), 7
    rank[n] = -1
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    places = np.arange(n)
    while True:
        rank[sa] = np.maximum.accumulate(np.where(head, places, 0))
        tied = np.flatnonzero(~head | ~np.append(head[1:], True))
        if not len(tied):
            return sa
        sub = sa[tied]
        pair = rank[sub] * (n + 1) + rank[np.minimum(sub + h, n)] + 1
        order = np.argsort(pair)
        sa[tied] = sub[order]
        pair = pair[order]
        head[tied] = np.concatenate([[True], pair[1:] != pair[:-1]])
        h *= 2


def common_prefixes(b: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Length, up to cap, that each suffix in order shares with the one before it. Kasai's bound (the next suffix of the
    text shares at most one byte less) carries what every 64th position found over to those behind it."""
    n = len(b)
    before = np.empty(n, np.int64)
    before[sa[0]] = n
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([b, np.zeros(16, np.uint8)]).astype(np.uint64)
    word = np.zeros(n + 8, np.uint64)
    for i in range(8):
        word |= padded[i:i + n + 8] << np.uint64(8 * i)
    plcp = np.zeros(n, np.int64)

    def extend(at: np.ndarray, got: np.ndarray, most: int) -> None:
        plcp[at] = got
        while len(at):
            a, c = at + got, before[at] + got
            live = (a < n) & (c < n) & (got < most)
            plcp[at[~live]] = got[~live]
            at, got, a, c = at[live], got[live], a[live], c[live]
            diff = word[a] ^ word[c]
            same = diff == 0
            low = diff & (~diff + np.uint64(1))  # lowest differing bit
            bytes_ = np.where(same, 8, np.log2(np.where(same, 1, low).astype(np.float64)).astype(np.int64) // 8)
            got = np.minimum(got + bytes_, np.minimum(n - at, n - before[at]))
            plcp[at] = got
            at, got = at[same], got[same]

    step = 64
    every = np.arange(0, n, step)
    extend(every, np.zeros(len(every), np.int64), cap + step)
    rest = np.flatnonzero(np.arange(n) % step)
    extend(rest, np.maximum(0, plcp[rest - rest % step] - rest % step), cap)
    lcp = np.minimum(plcp[sa], cap)
    lcp[0] = 0
    return lcp


def repeated_windows(regions: list[bytes], copies: np.ndarray, length: int) -> list[np.ndarray]:
    """Per region a flag for every window of length bytes: whether it is found at two places, counting copies."""
    sizes = np.array([len(r) for r in regions])
    b = np.frombuffer(b"".join(regions), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    region = np.repeat(np.arange(len(regions)), sizes)
    valid = np.arange(len(b)) + length <= (first + sizes)[region]
    sa = suffix_array(b)
    lcp = common_prefixes(b, sa, length)
    mine = np.flatnonzero(valid[sa])
    flag = np.zeros(len(b), bool)
    if len(mine):
        # ends behind the last valid suffix: those that sort after it belong to no window
        between = np.minimum.reduceat(lcp[:mine[-1] + 1], mine[:-1] + 1) if len(mine) > 1 else np.zeros(0, np.int64)
        group = np.cumsum(np.concatenate([[0], between < length]))
        total = np.bincount(group, copies[region[sa[mine]]])
        flag[sa[mine]] = total[group] > 1
    return [flag[f:f + max(0, s - length + 1)] for f, s in zip(first, sizes)]


def window_hashes(region: bytes, length: int) -> np.ndarray:
    """64-bit fingerprints of a region's windows."""
    b = _BYTE[np.frombuffer(region, np.uint8)]
    up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b) - 1, p, np.uint64)]), dtype=np.uint64) for p in (_P, pow(_P, -1, 1 << 64)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(b * up, dtype=np.uint64)])
    return mix((total[length:] - total[:-length]) * down[:len(b) - length + 1])


def _ranges(flag: np.ndarray) -> list[int]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return edge.tolist()


def with_digest(docs: DataFrame, text_col: str = "text", d1: str = "d1", d2: str = "d2") -> DataFrame:
    """Adds d1, d2: a 128-bit digest that names a text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({d1: F.xxhash64(text), d2: F.xxhash64(F.lit("second"), text)})


def repeated_spans(docs: DataFrame, length: int = 400, text_col: str = "text") -> DataFrame:
    """d1, d2, spans: for every distinct text with a string of length bytes that starts at two places or more, the
    maximal byte runs [from, to) that such strings cover.

    Every window is dealt to its least gram. Windows whose gram is found once cannot repeat and leave here; the others
    travel in regions (a gram's run of windows), equal regions as one with a count. All regions of a gram share a
    shard, where a suffix array finds equal windows; a gram with more bytes than a shard holds is split, and its
    shards exchange sorted window fingerprints by hash range, found in each other by binary search. So no shard, group
    or task grows with how often a passage occurs. Texts that are copied whole are covered whole and take part once.
    """
    arrow_batches(docs.sparkSession)
    d = with_digest(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))).withColumn("n", F.octet_length("text"))
    d = d.where(F.col("n") >= length).select("d1", "d2", "n", "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fps, counts = [], [], []
            for row, _, _, fp in anchor_runs(*utf8(batch.column(3)), length):
                pair = np.unique(np.stack([row, fp]), axis=1, return_counts=True) if len(row) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                rows.append(pair[0][0])
                fps.append(pair[0][1])
                counts.append(pair[1])
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(fps)), pa.array(np.concatenate(counts))], ["d1", "d2", "fp", "c"])

    found = d.mapInArrow(anchors, "d1 long, d2 long, fp long, c long")
    found = materialize(found.groupBy("fp", "d1", "d2").agg(F.sum("c").alias("c")))
    live = materialize(found.groupBy("fp").agg(F.sum("c").alias("c")).where("c > 1").select("fp"))
    texts = materialize(found.join(live, "fp", "left_semi").groupBy("d1", "d2").agg(F.collect_set("fp").alias("fps")))
    copies = materialize(d.groupBy("d1", "d2", "n").agg(F.count("*").alias("copies")))
    picked = d.dropDuplicates(["d1", "d2"]).join(texts.join(copies.select("d1", "d2", "copies"), ["d1", "d2"]), ["d1", "d2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out: list[tuple] = []
            for row, first, last, fp in anchor_runs(data, offsets, length):
                edge = np.searchsorted(row, np.arange(len(batch) + 1))
                for r in np.unique(row):
                    known = np.array(batch.column("fps")[int(r)].as_py(), np.int64)
                    here = np.arange(edge[r], edge[r + 1])
                    here = here[np.isin(fp[here], known)]
                    seen: dict[tuple, list[int]] = {}
                    for i in here:
                        lo = offsets[r] + first[i]
                        text = data[lo:lo + last[i] - first[i] + length].tobytes()
                        seen.setdefault((int(fp[i]), text), []).append(int(first[i]))
                    for (f, text), starts in seen.items():
                        digest = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.int64)
                        out.append((batch.column(0)[int(r)].as_py(), batch.column(1)[int(r)].as_py(), f, int(digest[0]), int(digest[1]), starts, len(starts) * batch.column("copies")[int(r)].as_py(), text))
            if out:
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32()), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["d1", "d2", "fp", "r1", "r2", "starts", "copies", "region"])

    regions = materialize(picked.select("d1", "d2", "fps", "copies", "text").mapInArrow(cut, "d1 long, d2 long, fp long, r1 long, r2 long, starts array<int>, copies long, region binary"))
    distinct = materialize(regions.groupBy("fp", "r1", "r2").agg(F.sum("copies").alias("copies"), F.first("region").alias("region")))
    per = distinct.groupBy("fp").agg(F.sum(F.octet_length("region")).alias("bytes"), F.count("*").alias("n"))
    per = materialize(per.select("fp", "n", F.ceil(F.col("bytes") / SHARD_BYTES).cast("int").alias("subs"), "bytes"))
    total = per.where("n > 1").agg(F.sum("bytes")).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    sharded = distinct.join(per, "fp").withColumn("sub", F.when(F.col("subs") > 1, F.pmod("r1", F.col("subs"))).otherwise(F.lit(-1)).cast("int"))
    sharded = sharded.withColumn("shard", F.when(F.col("sub") < 0, F.pmod(F.xxhash64("fp"), F.lit(shards))).otherwise(F.col("fp")))
    schema = "fp long, r1 long, r2 long, ranges array<int>"

    def local(table: pa.Table) -> pa.Table:
        raw = table.column("region").to_pylist()
        flags = repeated_windows(raw, table.column("copies").to_numpy(), length)
        return pa.table({c: table.column(c) for c in ("fp", "r1", "r2")} | {"ranges": pa.array([_ranges(f) for f in flags], pa.list_(pa.int32()))})

    alone = distinct.join(per.where("n = 1").select("fp"), "fp", "left_semi").where("copies > 1")
    alone = alone.select("fp", "r1", "r2", F.array(F.lit(0), (F.octet_length("region") - length + 1).cast("int")).alias("ranges"))
    one = sharded.where("n > 1 and sub < 0").select("shard", "fp", "r1", "r2", "copies", "region").groupBy("shard").applyInArrow(local, schema)
    hot = sharded.where("sub >= 0").select("fp", "sub", "subs", "r1", "r2", "copies", "region")
    result = alone.unionAll(one)
    if not per.where("subs > 1").limit(1).isEmpty():
        result = result.unionAll(_split_grams(materialize(hot), length, schema))
    result = materialize(result.where(F.size("ranges") > 0))
    shift = F.expr("flatten(transform(starts, s -> transform(sequence(0, size(ranges) div 2 - 1), i -> struct(s + ranges[2 * i] as a, s + ranges[2 * i + 1] - 1 + %d as b))))" % length)
    runs = regions.join(result, ["fp", "r1", "r2"]).select("d1", "d2", shift.alias("runs"))
    runs = runs.groupBy("d1", "d2").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    # joined runs, in time linear in the sorted ends: the i-th start begins a run if i ends lie before it, and then the
    # last of these ends one
    ends = runs.select("d1", "d2", F.expr("sort_array(transform(runs, x -> x.a))").alias("a"), F.expr("sort_array(transform(runs, x -> x.b))").alias("b"))
    joined = F.expr("""zip_with(filter(a, (x, i) -> coalesce(x > get(b, i - 1), true)), filter(b, (x, i) -> coalesce(x < get(a, i + 1), true)),
        (x, y) -> struct(x as `from`, y as `to`))""")
    out = materialize(ends.select("d1", "d2", joined.alias("spans")))
    release(found, live, texts, regions, distinct, per, result, copies)
    return out


def _split_grams(hot: DataFrame, length: int, schema: str) -> DataFrame:
    """Repeated windows of grams that fill several shards: each shard's suffix array settles what repeats in it and
    sorts its window fingerprints; ranges of equal hash width from all shards of a gram meet and look each other up."""

    def prints(table: pa.Table) -> pa.Table:
        raw, subs = table.column("region").to_pylist(), table.column("subs")[0].as_py()
        flag = np.concatenate(repeated_windows(raw, table.column("copies").to_numpy(), length))
        value, at = np.unique(np.concatenate([window_hashes(r, length) for r in raw]), return_index=True)
        flag = flag[at]
        cuts = np.searchsorted(value, np.array([(i << 64) // subs for i in range(1, subs)], np.uint64))
        rows = list(zip(np.split(value, cuts), np.split(flag, cuts)))
        n = len(rows)
        return pa.table({"fp": pa.array([table.column("fp")[0].as_py()] * n, pa.int64()), "sub": pa.array([table.column("sub")[0].as_py()] * n, pa.int32()), "part": pa.array(range(n), pa.int32()),
                         "value": pa.array([v.tobytes() for v, _ in rows], pa.binary()), "flag": pa.array([f.tobytes() for _, f in rows], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        values = [np.frombuffer(x, np.uint64) for x in table.column("value").to_pylist()]
        flags = [np.frombuffer(x, bool) for x in table.column("flag").to_pylist()]
        union, count = np.unique(np.concatenate(values), return_counts=True)
        repeated = count > 1
        for v, f in zip(values, flags):
            repeated[np.searchsorted(union, v[f])] = True
        hits = [v[repeated[np.searchsorted(union, v)]].tobytes() for v in values]
        return pa.table({"fp": table.column("fp"), "sub": table.column("sub"), "hits": pa.array(hits, pa.binary())})

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        hits = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in right.column("hits").to_pylist()] + [np.zeros(0, np.uint64)]))
        ranges = []
        for r in left.column("region").to_pylist():
            h = window_hashes(r, length)
            at = np.minimum(np.searchsorted(hits, h), max(0, len(hits) - 1))
            ranges.append(_ranges(hits[at] == h if len(hits) else np.zeros(len(h), bool)))
        return pa.table({c: left.column(c) for c in ("fp", "r1", "r2")} | {"ranges": pa.array(ranges, pa.list_(pa.int32()))})

    sent = hot.groupBy("fp", "sub").applyInArrow(prints, "fp long, sub int, part int, value binary, flag binary")
    met = materialize(sent.groupBy("fp", "part").applyInArrow(meet, "fp long, sub int, hits binary"))
    return hot.groupBy("fp", "sub").cogroup(met.groupBy("fp", "sub")).applyInArrow(mark, schema)


def remove_repeats(docs: DataFrame, length: int = 400, text_col: str = "text", whole_chars: bool = False) -> DataFrame:
    """All columns of docs with n_bytes, spans (removed byte runs) and kept (the remaining bytes) for every row.

    Null text counts as empty; texts shorter than length keep everything; repeated rows and copies of long texts lose
    everything, each of them; all strings are judged on the input. Columns of docs with these names are replaced.
    whole_chars: a run that starts or ends inside a character leaves that character, so kept stays valid UTF-8.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.drop("spans", "kept", "n_bytes")
    spans = repeated_spans(docs.select(text_col), length, text_col).withColumnsRenamed({"d1": "__d1", "d2": "__d2"})
    d = with_digest(docs, text_col, "__d1", "__d2").join(hinted(spans, most_bytes=16 << 20), ["__d1", "__d2"], "left").drop("__d1", "__d2")
    names = d.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(names.index(text_col)))
            kept = []
            for i, runs in enumerate(batch.column(names.index("spans")).to_pylist()):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                at, out = 0, []
                for run in runs or ():
                    a, b = run["from"], run["to"]
                    if whole_chars:
                        while a < b and text[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                            b -= 1
                    out.append(text[at:a])
                    at = b
                kept.append(b"".join(out) + text[at:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(offsets)), pa.array(kept, pa.binary())], [*names, "n_bytes", "kept"])

    from pyspark.sql import types as T

    schema = T.StructType([*d.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType())])
    return d.mapInArrow(apply, schema)

"""Near-duplicate, passage, vector and line operators against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

import entityspark.llm.embedding_dedup as E
import entityspark.llm.line_dedup as L
import entityspark.llm.minhash as M
import entityspark.llm.suffix_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    out = [None, "", " \t\n", "one", "One", "two words", "ÄÖ x\u00a0y z", "a b c"]
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append(" ".join(t))
    out += [out[-1]] * 4 + [" ".join(rng.choice(words) for _ in range(200)) for _ in range(10)]
    return out


def test_minhash_equals_brute_force(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for k, percent in ((3, 85), (5, 80)):
        sets = {}
        for i, t in enumerate(texts):
            w = WORD.findall((t or "").translate(LOWER))
            sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        want = components(sets, links)
        got = M.minhash_components(d, k, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_minhash_open_buckets_and_blocks(spark, texts, monkeypatch):
    """Small blocks: members that the star leaves apart still meet all others."""
    real = M._open_links
    seen = []
    monkeypatch.setattr(M, "_open_links", lambda o, r, d, k, p: seen.append(o.count()) or real(o, r, d, k, p, block_rows=7))
    test_minhash_equals_brute_force(spark, texts)
    assert max(seen) > 50


def test_minhash_repeats_nulls_empty(spark):
    d = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in M.minhash_components(d).collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, 3, False), (9, 9, True)], key=str)
    assert M.minhash_components(d.limit(0)).count() == 0


def test_minhash_repeated_ids_with_other_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (4, b), (9, "alone in the world"), (None, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in M.minhash_components(d, 3, 85).collect()), key=str)
    assert got == sorted([(5, 5, True), (7, 5, False), (None, 5, False), (5, 4, False), (8, 4, False), (4, 4, True), (9, 9, True)], key=str)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 2), (50, 2), (2000, 2), (3000, 4)):
        b = rng.integers(97, 97 + letters, n).astype(np.uint8)
        if n == 3000:
            b[1500:2700] = b[100:1300]
        sa, t = S.suffix_array(b), b.tobytes()
        assert list(sa) == sorted(range(n), key=lambda i: t[i:])
        lcp = S.common_prefixes(b, sa, 400)
        for q in range(1, n):
            x, y, m = t[sa[q - 1]:], t[sa[q]:], 0
            while m < min(len(x), len(y), 400) and x[m] == y[m]:
                m += 1
            assert lcp[q] == m


def brute_spans(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                hit[i] += 1
                hit[i + length] -= 1
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(hit)[:-1] > 0).astype(int), [0]])))
        out.append([tuple(x) for x in edge.reshape(-1, 2).tolist()])
    return out


@pytest.mark.parametrize("shard", [1 << 20, 3000])
def test_repeats_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(S, "SHARD_BYTES", shard)  # the small one splits common passages over shards
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdeé fg") for _ in range(n))
    passage, other = noise(700), noise(401)
    texts = [None, "", "short", "xy" * 900, noise(900), noise(399)]
    texts += [noise(rng.randint(0, 300)) + passage[rng.randint(0, 200):rng.randint(500, 700)] + noise(rng.randint(0, 300)) for _ in range(60)]
    texts += [noise(50) + other + noise(50) + other, noise(800)] + [texts[-1]] * 3 + ["é" + passage[:450], "\u0169" + passage[:450]]
    d = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(5)
    got = {r.doc_id: r for r in S.remove_repeats(d).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, want in enumerate(brute_spans(raw, 400)):
        assert [(s["from"], s["to"]) for s in got[i].spans or []] == want, i
        at, kept = 0, b""
        for a, b in want:
            kept, at = kept + raw[i][at:a], b
        assert bytes(got[i].kept) == kept + raw[i][at:] and got[i].n_bytes == len(raw[i])
    whole = {r.doc_id: bytes(r.kept).decode() for r in S.remove_repeats(d, whole_chars=True).collect()}
    assert len(whole) == len(texts)
    assert S.remove_repeats(d.limit(0)).count() == 0


def test_greatest_window_of_a_shard_repeats(spark):
    """An exact repeat of the length that sorts last, with suffixes behind it that run past their region."""
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = "y" + noise(199) + "z" + noise(199)
    texts = [noise(300) + passage, noise(500) + passage, noise(900)]
    flags = S.repeated_windows([t.encode() for t in texts], np.ones(3, np.int64), 400)
    assert [np.flatnonzero(f).tolist() for f in flags] == [[300], [500], []]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.remove_repeats(d).collect()}
    for i, want in enumerate(brute_spans([t.encode() for t in texts], 400)):
        assert [(s["from"], s["to"]) for s in got[i].spans or []] == want, i


def test_vectors_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    v = [(c + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.3])).tolist() for c in centres[rng.integers(0, 6, 300)]]
    v += [v[0], v[0], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, None, [], [1.0, None] + [0.0] * 14, [1.0, 2.0], [2.0, 4.0]]
    ids = list(range(len(v)))
    d = spark.createDataFrame(list(zip(ids, v)), "vec_id long, embedding array<double>").repartition(4)
    ok = {i: np.array(x, float) for i, x in zip(ids, v) if x and None not in x and np.isfinite(x).all() and any(x)}
    links = [(a, b) for a, b in combinations(ok, 2) if len(ok[a]) == len(ok[b]) and (np.array_equal(ok[a], ok[b]) or ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.95)]
    n, comp = Counter(x for e in links for x in e), components(ids, links)
    for cell, block in ((2048, 8192), (20, 16)):
        monkeypatch.setattr(E, "_pivots", (lambda f: lambda r, count, *a: f(r, count, *a) if cell == 2048 else E.unit_vectors(r.orderBy("rep").limit(5).select("embedding").toArrow().column(0)))(E._pivots)) if cell == 20 else None
        got = E.embedding_components(d, cell=cell, block=block).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], comp[i], comp[i] == i) for i in ids}
    assert E.embedding_components(d.limit(0)).count() == 0


def test_vectors_of_single_precision_stay_so(spark, monkeypatch):
    """Cells and blocks shuffle copies of the vectors as they came, and leave Python a few at a time; same links."""
    from pyspark.sql import functions as F

    rng, kinds = np.random.default_rng(5), []
    v = rng.normal(size=(8, 24))[rng.integers(0, 8, 120)] + rng.normal(size=(120, 24)) * 0.15
    d = spark.createDataFrame([(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)] + [(120, [-0.0] + [1.0] * 23), (121, [0.0] + [1.0] * 23)], "vec_id long, embedding array<float>")
    want = sorted(E.embedding_components(d.withColumn("embedding", F.col("embedding").cast("array<double>"))).collect())
    real = E.materialize
    monkeypatch.setattr(E, "materialize", lambda f: (kinds.append(dict(f.dtypes).get("embedding")), real(f))[1])
    monkeypatch.setattr(E, "ENTRIES", 40)
    monkeypatch.setattr(E, "SENT", 60)
    assert sorted(E.embedding_components(d, cell=20, block=16).collect()) == want and sum(r.n_links for r in want) > 100
    assert set(kinds) == {"array<float>", None}


def py_norm(line):
    import regex

    return regex.sub("[0-9]+", "0", regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower())).strip(" ")


def py_simhash(norm):
    words = set(norm.split(" "))
    count = [0] * 64
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if count[b] > len(words) // 2)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def py_anchors(norm):
    """The three smallest hashes of a line's runs of three words with twelve letters or more, as Spark hashes several values."""
    w, out = norm.split(" "), set()
    for run in zip(w, w[1:], w[2:]):
        if sum(map(len, run)) >= 12:
            h = 42
            for x in run:
                h = xxhash.xxh64_intdigest(x.encode(), h)
            out.add(h - (1 << 64) if h >> 63 else h)
    return set(sorted(out)[:3])


def test_vectors_of_many_lengths(spark):
    rows = [(i, [1.0] * (i % 90 + 1)) for i in range(200)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (len(range(i % 90, 200, 90)) - 1, i % 90) for i in range(200)}


def test_vectors_of_extreme_components(spark):
    big, small = [[1e200, 1e200], [2e200, 2e200], [1e200, -1e200]], [[1e-200, 1e-200, 0.0], [3e-200, 3e-200, 0.0], [0.0, 0.0, 1e-200]]
    rows = list(enumerate(big + small + [[1.7e308] * 4, [1e-300] * 4]))
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6)}


def test_repeats_of_many_runs_and_columns_of_any_name(spark):
    """A text of many separate repeated runs, touching and nested ones; columns named like helpers stay."""
    rng = random.Random(3)
    part = ["".join(rng.choice("abcdefgh") for _ in range(260)) for _ in range(30)]
    glue = lambda: "".join(rng.choice("stuvwxyz") for _ in range(rng.randint(0, 9)))
    texts = ["".join(rng.choice(part) + glue() for _ in range(60)) for _ in range(6)] + [part[0], part[0] + part[1], ""]
    d = spark.createDataFrame([(i, t, i, -i) for i, t in enumerate(texts)], "doc_id long, text string, d1 long, d2 long")
    got = {r.doc_id: r for r in S.remove_repeats(d, length=200).collect()}
    for i, want in enumerate(brute_spans([t.encode() for t in texts], 200)):
        assert [(s["from"], s["to"]) for s in got[i].spans or []] == want and (got[i].d1, got[i].d2) == (i, -i), i


def line_link(a, b):
    """Whether two normal forms are linked."""
    bits = (py_simhash(a) ^ py_simhash(b)).bit_count()
    most = int(max(len(a), len(b)) * 0.2 + 1e-9)
    return (bits <= 3 or bits <= 14 and bool(py_anchors(a) & py_anchors(b))) and abs(len(a) - len(b)) <= most and edit(a, b) <= most


def test_lines_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "echo", "fox"] + [f"{a}{b}q" for a in "bcdfgh" for b in ("ar", "el", "im", "on", "ut", "yrk", "osa", "ilt", "emp", "und")]
    base = [rng.choice(words) for _ in range(24)]
    lines = ["", "!!!", "Same line 12", "same  LINE 7!", "x"]
    for _ in range(40):
        t = list(base)
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(24)] = rng.choice(words)
        lines.append(" ".join(t))
        lines += [" ".join(f"{a}{b}" for a in "abcdefghijkl" for b in "qrstuvwxyzäö"[:12]) + end for end in ("", " more", " or less")]  # 144 words
    lines += [f"{' '.join(rng.choice(words) for _ in range(n))}{e}" for n in (3, 9, 17) for e in ("", " … end", "?!", " 12 7")]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))), "c") for i in range(40)] + [(90, None, "c"), (91, "", "c"), (92, "x\nx\n", "c"), (93, "\n".join(["z", *lines, "z"] * 3), "c")]
    d = spark.createDataFrame(docs, "doc_id long, text string, line string").repartition(3)
    places = sorted((i, n, py_norm(x)) for i, t, _ in docs for n, x in enumerate((t or "").split("\n")) if py_norm(x))
    norms = sorted({p[2] for p in places})
    sig = {x: py_simhash(x) for x in norms}
    anchors = {x: py_anchors(x) for x in norms}

    def candidates(a, b):
        bits = (sig[a] ^ sig[b]).bit_count()
        return bits <= 3 or bits <= 14 and bool(anchors[a] & anchors[b])

    alike = [(a, b) for a, b in combinations(norms, 2) if abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and edit(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    links = [e for e in alike if candidates(*e)]
    group = components(norms, links)
    assert links and len(links) >= 0.3 * len(alike)
    first = {}
    for p in places:
        first.setdefault(group[p[2]], p[:2])
    gone = defaultdict(set)
    for i, n, x in places:
        if first[group[x]] != (i, n):
            gone[i].add(n)
    got = {r.doc_id: r for r in L.dedup_lines(d).collect()}
    for i, t, _ in docs:
        want = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
        assert (got[i].text, got[i].n_removed, got[i].line) == (want, len(gone[i]), "c"), i
    assert L.dedup_lines(d.limit(0)).count() == 0


def test_lines_repeated_ids_nulls_and_clashing_columns(spark):
    rows = [(1, "same here\nonly one", "g"), (1, "same here\nother", "h"), (None, "Same, here", "i"), (2, None, "j"), (3, "same here", "k"), (4, "\n", "l")]
    d = spark.createDataFrame(rows, "doc_id long, text string, place string").repartition(2)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed, r.place) for r in L.dedup_lines(d).collect()), key=str)
    # the row without an id comes first in order, so it keeps the line
    want = [(1, "only one", 2, 1, "g"), (1, "other", 2, 1, "h"), (None, "Same, here", 1, 0, "i"), (2, None, 0, 0, "j"), (3, "", 1, 1, "k"), (4, "\n", 2, 0, "l")]
    assert got == sorted(want, key=str)


def test_lines_recall_against_edit_similarity_alone(spark):
    """Lines with edits anywhere, held against edit similarity and nothing else: at least 0.9 of the pairs are linked."""
    rng = random.Random(31)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    lines, pairs = [], []
    for i in range(160):
        x = [rng.choice(words) for _ in range((8, 15, 40, 90)[i % 4])]
        y = list(x)
        for _ in range(rng.randint(1, max(1, len(x) // 12))):
            at = rng.randrange(len(y))
            y[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
        x, y = " ".join(x), " ".join(y)
        lines += [x, y]
        if x != y and abs(len(x) - len(y)) <= 0.2 * max(len(x), len(y)) and edit(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9):
            pairs.append((len(lines) - 2, len(lines) - 1))
    d = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    gone = {r.doc_id for r in L.dedup_lines(d).where("n_removed = 1").collect()}
    assert gone <= {b for _, b in pairs} | {b for a, b in zip(range(0, 320, 2), range(1, 320, 2)) if lines[a] == lines[b]}
    assert len(pairs) > 120 and sum(b in gone for _, b in pairs) >= 0.9 * len(pairs)


def test_line_keys_of_many_alike_lines_stay_linear(spark):
    """A block that many lines share gives each line a bounded number of candidates, not all pairs."""
    from pyspark.sql import functions as F

    base = " ".join(f"word{i}" for i in range(40))
    counts = []
    for n in (100, 400):
        d = spark.createDataFrame([(i, f"{base} tail{i}x") for i in range(n)], "doc_id long, text string")
        sig = L.signatures(L.split_lines(d))
        keyed = sig.select("id", F.explode(F.filter(F.concat(L.block_keys("sig", n), F.array(*L._ANCHORS)), lambda x: x.isNotNull())).alias("key"))
        least = keyed.groupBy("key").agg(F.min("id").alias("least"))
        counts.append(keyed.join(least, "key").where("id != least").select("id", "least").distinct().count())
        assert L.dedup_lines(d).where("text = ''").count() == n - 1
    assert counts[1] <= 8 * counts[0]


def test_lines_that_meet_by_chance_make_no_pairs(spark, monkeypatch):
    """Lines that share keys and no likeness: a key's aggregation or join ends them, no pair is written."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    lines = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(8)) for _ in range(150)]
    d = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    rows, write = [], L.materialize

    def counted(df):
        out = write(df)
        if out.columns[:2] == ["a", "b"]:
            rows.append(out.count())
        return out

    monkeypatch.setattr(L, "materialize", counted)
    monkeypatch.setattr(L, "block_keys", lambda sig, n: F.array(F.pmod(F.col(sig), F.lit(100)) * 2))
    assert L.dedup_lines(d).where("n_removed > 0").isEmpty()
    assert rows and not any(rows)


def test_line_pairs_of_a_shared_passage_come_once(spark, monkeypatch):
    """Lines with a passage in common and other words around it share several anchors and are not similar: each pair is
    counted under one of them only."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = [word() for _ in range(36)]
    norms = [" ".join([*(word() for _ in range(i % 3 * 5)), *passage, *(word() for _ in range((2 - i % 3) * 5 + 7))]) for i in range(24)]
    sig, anchors = {x: py_simhash(x) for x in norms}, {x: py_anchors(x) for x in norms}
    pairs = [(a, b) for a, b in combinations(norms, 2) if (sig[a] ^ sig[b]).bit_count() <= 14 and anchors[a] & anchors[b]]
    assert sum(len(anchors[a] & anchors[b]) for a, b in pairs) > 1.2 * len(pairs) > 60 and not any(line_link(a, b) for a, b in pairs)
    counts, write = [], L.materialize

    def counted(df):
        out = write(df)
        if {"p", "n"} <= set(out.columns):
            counts.append(out.agg({"n": "sum"}).first()[0])
        return out

    monkeypatch.setattr(L, "materialize", counted)
    d = spark.createDataFrame(list(enumerate(norms)), "doc_id long, text string")
    assert L.dedup_lines(d).where("n_removed > 0").isEmpty()
    assert counts and 0 < counts[0] <= len(pairs)


def test_word_by_word_bound(spark):
    """Never below the edit distance, and equal to it for words replaced by others of their length."""
    from pyspark.sql import functions as F

    rng = random.Random(12)
    words = [a + b for a in "abcdef" for b in ("x", "yz", "www")]
    rows = []
    for _ in range(150):
        x = [rng.choice(words) for _ in range(rng.randint(1, 12))]
        y = list(x)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(y) + 1)
            y[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
        rows.append((" ".join(x), " ".join(y or ["a"])))
    rows += [("aa bb cc", "aa dd cc"), ("aa bb cc", "aa bb cc"), ("aa bb cc", "aa xxx bb cc")]
    got = spark.createDataFrame(rows, "x string, y string").select("x", "y", F.expr(L._at_most("x", "y")).alias("n")).collect()
    assert all(r.n >= edit(r.x, r.y) for r in got) and [r.n for r in got[-3:]] == [2, 0, 4]


def test_block_keys_share_one_within_the_bits(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        rows.append((a - (1 << 63), b - (1 << 63)))
    d = spark.createDataFrame(rows, "a long, b long")
    for n in (10, 10**8, 10**11):
        assert d.where(F.size(F.array_intersect(L.block_keys("a", n), L.block_keys("b", n))) == 0).count() == 0


@pytest.mark.parametrize("name", ["op4_embedding_dedup", "op7_chat_formatting", "op9_minhash"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from entityspark.llm import queries as Q
    from tests.test_queries import rows

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows(Q.queries()[name](spark, sf).toPandas()) == rows(con.execute(Q.oracle_sql()[name]).df())


def test_joins_are_merged_beyond_the_bound(spark):
    from entityspark.llm.common import hinted
    from entityspark.storage import materialize

    keys = materialize(spark.range(100))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString().lower()
    other = spark.range(10**7)
    assert "strategy=broadcast" in plan(other.join(hinted(keys), "id")) and "strategy=merge" in plan(other.join(hinted(keys, most=99), "id")) and "strategy=merge" in plan(other.join(hinted(keys, most_bytes=10), "id"))

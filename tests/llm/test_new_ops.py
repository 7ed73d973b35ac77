"""Whitening, personal data and spelling variants, against plain Python versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityspark.llm.personal_data import FEATURES, KINDS, SpanClassifier, VoteModel, candidate_spans, personal_spans, span_digests
from entityspark.llm.spelling import near_pairs, neighbour_keys, reduced_keys, spelling_variants
from entityspark.llm.whitening import Spectrum, Whitening, positive_eigenvalues, whiten_vectors


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text: str | None) -> list[tuple[str, int, int]]:
    """The base spans by the contract's own patterns."""
    shapes = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    tests = {"email": lambda h: True, "ip": lambda h: all(int(p) <= 255 for p in h.split(".")), "card": lambda h: 16 <= len(d := re.sub("[ -]", "", h)) <= 19 and luhn(d), "phone": lambda h: 8 <= len(re.sub("[^0-9]", "", h)) <= 15}
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(shapes[k], text or "") if tests[k](m.group())]


ODD = ["a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 00000001.2.3.4 😀 x@y.zz, +1 (555) 123-4567 4111 1111 1111 1111 9-9", None, "", "@" * 50, "1" * 20000, "a." * 5000, "q@w.ee " * 3000, "a@" + "b." * 5000 + "c",
       "1 " * 5000, "+1 " + " " * 5000, "+12345678+12345678 a@b@c.d 4111-1111-1111-1111", "00256.1.1.1 256.1.1.1 1.2.3", "é@x.y a b@c.d"]
SPELLED = "mail jane.doe [at] example [dot] org or call (743) 555-3824. card number 3782 822463 10005; ip 10[.]1[.]2[.]3 and 2001:db8::ff00:42:8329."
CLEAN = "Meet at noon. Look at example.com on 2023-01-15 or 15.01.2023 12:30:45, version 1234567, isbn 978-3-16-148410-0, 3.14159265, 1,234,567 and 100 200 300."


@pytest.fixture(scope="module")
def personal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = [(-1 - i, t) for i, t in enumerate(ODD)] + [(-100, SPELLED), (-101, CLEAN), (-102, SPELLED), (-102, SPELLED), (None, "x@y.com")]
    docs = docs.unionAll(spark.createDataFrame(more, "doc_id long, text string")).withColumn("email", F.lit("clash")).withColumn("candidates", F.lit(1))
    return docs.select("doc_id", "text").collect(), span_digests(personal_spans(docs)).collect()


def test_base_spans_equal_the_contract(personal):
    texts, rows = personal
    want = Counter()
    for r in texts:
        b = base(r.text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        want[(r.doc_id, *(sum(k == x for x, _, _ in b) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    have = {r.doc_id: r.spans for r in rows}
    for r in texts:
        assert {f"{k}:{s}:{e}" for k, s, e in base(r.text)} <= set(have[r.doc_id].split(","))


def test_further_spans(personal):
    texts, rows = personal
    found = {r.doc_id: [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)] for r in rows}
    assert {(k, SPELLED[s:e]) for k, s, e in found[-100]} == {("email", "jane.doe [at] example [dot] org"), ("ip", "10[.]1[.]2[.]3"), ("ip", "2001:db8::ff00:42:8329"), ("card", "3782 822463 10005"), ("phone", "(743) 555-3824")}
    assert found[-101] == [] and found[-102] == found[-100]
    assert all(spans == sorted(spans, key=lambda t: (KINDS.index(t[0]), t[1])) for spans in found.values())
    clean = [r for r in texts if r.doc_id is not None and r.doc_id >= 0 and not re.search("[0-9@]", r.text or "")]
    assert clean and all(found[r.doc_id] == [] for r in clean)


def test_vote_model_and_classifier():
    good, bad = 2 + 3 * 2 + 9 * 2 + 27 + 81, 0 + 3 * 0 + 9 * 0 + 27 + 81
    model = VoteModel({("card", good): 100, ("card", bad): 100, ("card", 2 + 3 * 0 + 9 + 27 + 81): 5})
    assert model.posterior("card", good) > 0.99 and model.posterior("card", bad) < 0.01 and model.yes[1][2] > 0.9 > 0.1 > model.no[1][2]
    c = SpanClassifier([("card", 1 << FEATURES.index("check_yes"), 100, 99.0), ("card", 1 << FEATURES.index("check_no"), 100, 1.0)])
    assert c.score("card", 1 << FEATURES.index("check_yes")) > 0.9 and c.score("card", 1 << FEATURES.index("check_no")) < 0.1


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert personal_spans(docs).count() == 0 and candidate_spans(docs).count() == 0 and spelling_variants(docs).count() == 0


def variants(texts: list[tuple]) -> dict:
    """All of the contract in plain Python, each word against each."""
    count, lower = Counter(), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            w = w if h % 31 else w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += len(w) >= 7
    count = {w: n for w, n in count.items() if n >= 2}
    gone = {w: {w[:i] + w[i + 1:] for i in range(len(w))} for w in count}
    near = {w: set() for w in count}
    for a in count:
        for b in count:
            if a != b and (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1 or b in gone[a] or a in gone[b]):
                near[a].add(b)
    form = {}
    for w, n in count.items():
        best = min(((-count[x], x) for x in near[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), form[w] and count[form[w]]) for w, n in count.items()}


def test_spelling_variants_equal_plain_python(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcé"), rng.integers(7, 10))) for _ in range(60)] + ["Harbours", "harbors", "HARBOURS", "Ünïcodé÷", "x" * 3000, "x" * 3001, "aaaaaaa", "aaaaaaaa", "abababab"]
    pick = rng.zipf(1.4, 6000) % len(words)
    texts = [(i, " ".join(words[p] for p in pick[at:at + 60])) for i, at in enumerate(range(0, 6000, 60))] + [(3, None), (4, ""), (None, " ".join(words)), (7, " ".join(words)), (7, " ".join(words)), (8, "12 -- short")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    want = variants(texts)
    for cell in (4096, 1):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs, cell=cell).collect()}
        assert got == want
    assert sum(v[0] is not None for v in want.values()) > 5


def test_chains_of_forms_end_at_their_root(spark):
    rows = [(i, f"abcdefg{'h' * i} " * 11 ** (3 - i)) for i in range(4)]
    docs = spark.createDataFrame([(i, t if i < 3 else t * 2) for i, t in rows], "doc_id long, text string")
    assert {r.word: r.root for r in spelling_variants(docs, times=5, min_count=2).collect()} == {r: v[1] for r, v in variants_times([(i, t if i < 3 else t * 2) for i, t in rows], 5).items()}


def variants_times(texts, times):
    count = Counter(w for _, t in texts for w in t.split())
    lost = Counter()
    for i, t in texts:
        for w in t.split():
            h = zlib.crc32(f"{i}:{w}".encode())
            lost[w if h % 31 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    count = {w: n for w, n in lost.items() if n >= 2 and len(w) >= 7}
    up = {w: next((v for v in (w[:-1],) if v in count and count[v] >= times * n), None) for w, n in count.items()}

    def root(w):
        while up[w]:
            w = up[w]
        return w

    return {w: (None, root(w)) for w in count}


def test_reduced_neighbourhoods_meet_once(spark):
    """Every two reduced words at most one edit apart share exactly one key between one's neighbourhood and the other."""
    words = [np.asarray(t, np.uint64) for n in (1, 2, 3) for t in np.ndindex(*(3,) * n)]
    for a in words:
        _, keys = neighbour_keys(a[None], 3)
        for b in words:
            _, back = neighbour_keys(b[None], 3)
            hits = int((keys == reduced_keys(b[None])).sum()) + int((back == reduced_keys(a[None])).sum())
            x, y = a.tolist(), b.tolist()
            edit = x == y or len(x) == len(y) and sum(i != j for i, j in zip(x, y)) == 1 or any(x[:i] + x[i + 1:] == y for i in range(len(x))) or any(y[:i] + y[i + 1:] == x for i in range(len(y)))
            assert hits == (2 if x == y else int(edit))


def test_near_pairs_of_a_hot_reduced_form(spark):
    """Words that all reduce to one form: letters eight code points apart."""
    words = ["".join(chr(97 + 8 * ((i >> k) % 3)) for k in range(0, 16, 2)) for i in range(0, 60000, 7)]
    words = sorted(set(words))[:400]
    d = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in near_pairs(d, cell=50).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if sum(x != y for x, y in zip(a, b)) == 1}


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 20):
        for _ in range(20):
            a = rng.integers(-3, 4, (d, d)).astype(float)
            a = a + a.T + rng.standard_normal((d, d)) * 1e-3
            a = a + a.T
            assert positive_eigenvalues(a) == int((np.linalg.eigvalsh(a) > 0).sum())
    assert positive_eigenvalues(np.zeros((3, 3))) == 0 and positive_eigenvalues(np.array([[0.0, 1], [1, 0]])) == 1


@pytest.mark.parametrize("e", [np.linspace(1, 0.1, 30), np.r_[np.ones(5), np.full(25, 0.5)], np.r_[1, 1 - 1e-13, 1 - 1e-9, 0.9, 0.9, np.linspace(0.8, 0.1, 25)], np.r_[[3, 2, 1], np.zeros(27)], 10.0 ** -np.arange(30), np.full(30, 2.0)])
def test_spectrum_slicing(e):
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((30, 30)))
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    values, vectors = Spectrum(v).leading(16)
    assert len(values) == min(16, int((e > 1e-13).sum())) or e[-1] < 1e-20
    assert np.abs(values - np.sort(e)[::-1][:len(values)]).max() < 1e-13 * e.max() and np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12 * e.max()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(5)
    e = (rng.standard_normal((300, 20)) * np.linspace(2, 0.2, 20)).astype(np.float32)
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(e)] + [(300 + i, [float(c) for c in e[0]], "x") for i in range(100)]
    odd = [(900, None, "n"), (901, [None] * 20, "n"), (902, [float("nan")] * 20, "n"), (903, [float("inf")] + [0.0] * 19, "n"), (904, [], "n"), (905, [1.0, 2.0], "s"), (906, [3.0, 5.0], "s"), (907, [1.0], "one"), (None, [float(c) for c in e[1]], "x"), (0, [float(c) for c in e[0]], "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, x string").withColumn("n", F.lit(1)).repartition(5)
    got = whiten_vectors(df).collect()
    ids = Counter(r.vec_id for r in got)
    assert not set(ids) & {900, 901, 902, 903, 904, 907} and ids[905] == ids[906] == 1 and ids[0] == 32 and ids[None] == 16 and ids[5] == 16
    x = np.floor(64 * e.astype(float)).astype(np.int64) + 1000000
    n, s = 300, x.sum(0)
    y = x - s / n
    v = np.cov(y.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    want = y @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    mine = np.zeros((300, 16))
    for r in got:
        if r.vec_id is not None and r.vec_id < 300:
            mine[r.vec_id, r.component - 1] = r.whitened
            assert r.n == 300 and r.deviation == sum(int(c) ** 2 for c in n * x[r.vec_id] - s) and abs(r.explained - values[::-1][r.component - 1] / np.trace(v)) < 1e-12 and r.identity_error < 1e-12
    assert np.abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-8
    assert whiten_vectors(df.limit(0)).count() == 0


def test_whitening_of_large_entries(spark):
    """Exact sums and deviations where products leave double precision; beyond a long a deviation is null."""
    rng = np.random.default_rng(6)
    e = rng.standard_normal((50, 3)) * [1e5, 1e3, 1]
    e = np.vstack([e, [1e300, 0, 0]])
    got = whiten_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "vec_id long, embedding array<double>")).collect()
    x = [[max(-(1 << 52), min(1 << 52, int(np.floor(64 * c)) if abs(c) < 1e200 else (1 << 52))) + 1000000 for c in v] for v in e]
    sums = [sum(c) for c in zip(*x)]
    for r in got:
        d = sum((51 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        assert r.deviation == (d if d < 1 << 63 else None)
    w = Whitening(2, [3, 7], np.array([[1.0, 0], [0, 4.0]]), 2)
    assert w.values.tolist() == [4.0, 1.0] and w.deviations(np.array([[1, 3]])) == [2]


def test_sql_of_spelling_variants(spark):
    import duckdb

    from entityspark.llm import queries as Q

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    got = {tuple(r) for r in Q.op13_spelling_variants(spark, sf).select(*columns).collect()}
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({Q.VARIANTS})").fetchall()
    assert got == set(want) and len(want) == len(got) > 1000

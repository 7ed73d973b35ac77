"""Operators on small hand-made tables, and properties against brute force."""

import json
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from entityspark.functions import text as X
from entityspark.operators import components, contrast, coverage, geo, golden, matching, places, quality, records, reports
from entityspark.plans.resolution import resolve
from entityspark.sources import keyed, flatten, tables, webpages
from entityspark.streaming import ingest as stream

RAW = "record_id long, source string, name string, legal_name string, place string, nit string, phone string, email string, address string, lat double, lon double, score int, approved boolean"


def corpus():
    r = lambda i, s, n, p, nit=None, ph=None, em=None, ad=None, lat=0.0, lon=0.0: (i, s, n, None, p, nit, ph, em, ad, lat, lon, 50, True)
    rows = [
        r(1, "rues", "Ferretería Uno S.A.S.", "Cali", "900123456"), r(2, "google_maps", "Otra Razón", "Bogotá", "900.123.456", ad="Cl 1 # 2-3"),  # same nit, two places
        r(3, "google_maps", "Depósito Norte", "Cali"), r(4, "serper", "deposito norte", "Tunja"),  # same name, two places
        r(5, "google_maps", "Aaaa", "Pasto", ph="+57 300 1111111"), r(6, "foursquare", "Bbbb", "Pasto", ph="3001111111", em="x@y.co"), r(7, "serper", "Cccc", "Pasto", em="X@Y.co "),  # a chain
        r(8, "google_maps", "Hierros del Valle Grande", "Neiva"), r(9, "serper", "Hierros del Valle Grandes", "Neiva"),  # similar only
        r(10, "rues", "Blanco Arriba", "Cali", ""), r(11, "serper", "Blanco Arriba", "Cali", "800999111"),  # blank above real
        r(12, "rues", "Corto Uno", "Cali", "777"), r(13, "rues", "Corto Dos", "Cali", "777"),  # short nit: two clusters, second dropped
        r(14, "rues", "Vieja Casa en liquidación", "Cali"), r(15, "serper", "Cerca Punto", "Ibagué", lat=4.6, lon=-74.1), r(16, "foursquare", "Cerca Punto", "Honda", lat=4.6001, lon=-74.1001)]
    return rows + [r(100 + i, "serper", f"Conmutador {chr(97 + i) * 6}", "Cali", ph="6015550000") for i in range(20)]  # one switchboard


@pytest.fixture(scope="module")
def resolved(spark):
    return resolve(spark.createDataFrame(corpus(), RAW).repartition(5))


def test_clusters(resolved):
    c = {r.record_id: r.entity for r in resolved.clustered.collect()}
    assert 14 not in c
    same = lambda *ids: len({c[i] for i in ids}) == 1
    assert same(1, 2) and same(5, 6, 7) and same(10, 11) and same(*range(100, 120)) and c[3] != c[4] and c[8] != c[9] and c[12] != c[13] and c[15] != c[16]


def test_golden_and_scores(resolved):
    e = {r.entity: r for r in resolved.entities.collect()}
    assert e[10].nit is None and e[1].nit == "900123456" and e[1].name == "Otra Razón" and e[1].main_source == "rues"
    assert 12 in e and 13 not in e and e[5].sources == ["foursquare", "google_maps", "serper"] and e[5].phone == "3001111111"
    assert e[1].quality == 25 + 15 + 10 + 10 + 10 + 20 + 15 and e[1].approved and e[100].n_matches == 190


def test_conflicts_and_rules(resolved):
    k = {(r.record_id, r.field) for r in resolved.conflicts.collect()}
    assert (12, "name") in k and (13, "name") in k and (10, "name") not in k
    m = {(r.a, r.b): r for r in resolved.matches.collect()}
    assert m[8, 9].rule == "similar_name" and m[8, 9].decision == "pending" and m[15, 16].rule == "near_name" and m[1, 2].score == 100


def test_star_and_all_pairs_cluster_alike_in_any_order(spark, resolved):
    d = spark.createDataFrame(sorted(corpus(), key=lambda r: -r[0]), RAW).repartition(2)
    other = resolve(d, pairs="all")
    pick = lambda x: sorted((r.record_id, r.entity) for r in x.clustered.collect())
    assert pick(resolved) == pick(other)
    key = lambda x: sorted(map(str, x.entities.collect()))
    assert key(resolved) == key(other)
    rules = {(r.a, r.b): r.rule for r in other.matches.collect()}
    assert all(rules[r.a, r.b] == r.rule for r in resolved.matches.collect())
    assert max(r.n_matches for r in resolved.entities.collect()) > 1


def test_contrast_equals_all_pairs(spark, sf, monkeypatch):
    """Every listing gets a row; repeated names, orders of tokens and sliced places change no best customer."""
    from entityspark import queries as Q
    from tests.plain_ratios import partial, token_sort

    ids = [r.record_id for r in Q.listings(spark, sf).select("record_id").collect()]
    assert sorted(r.prospect_id for r in Q.QUERIES["j9_j10_a22_contrast"](spark, sf).select("prospect_id").collect()) == sorted(ids)
    monkeypatch.setattr(contrast, "SLICE", 7)
    rng = random.Random(5)
    words = ["FERRO", "FERRE", "CASA", "CASAS", "NORTE", "DEPOSITO", "DEPOSITOS", "TORNILLO"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    p = [(i, name(), f"CALLE {rng.randint(1, 30)}", rng.choice(["CALI", "CALI", "PASTO"])) for i in range(80)] + [(900, None, "X", "CALI"), (901, "CASA", None, "NOWHERE")]
    c = [(f"c{i}", name(), f"CALLE {rng.randint(1, 30)}", rng.choice(["CALI", "CALI", "PASTO"]), i) for i in range(60)]
    got = {r.prospect_id: (r.code, r.score, r.category) for r in contrast.best_match(spark.createDataFrame(p, "prospect_id long, name string, address string, place string"), spark.createDataFrame(c, "code string, account string, address string, place string, seq long")).collect()}
    assert len(got) == len(p)
    for i, n, a, k in p:
        best = max(((token_sort(n, m), -q, code, b) for code, m, b, l, q in c if n and l == k), default=(0,))
        if best[0] < 70:
            assert got[i] == (None, None, "new")
        else:
            category = "confirmed" if best[0] >= 85 else "probable" if partial(a, best[3]) >= 60 else "new"
            assert got[i] == (best[2] if category != "new" else None, best[0], category), i


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    for n, m in ((30, 20), (200, 150), (60, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 40)]
        root = list(range(n + 50))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges + [(None, 3), (7, 7)], "a long, b long")).collect()}
        assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similarity_join_equals_all_pairs(spark):
    rng = random.Random(3)
    words = ["ferro", "ferre", "casa", "casas", "norte", "sur", "dep", "depo"]
    rows = [(i, rng.choice("xy"), " ".join(rng.choice(words) for _ in range(rng.randint(0, 3))) if i % 11 else None) for i in range(90)]
    d = spark.createDataFrame(rows, "record_id long, blk string, s string")
    for t in (0.5, 0.7, 0.8):
        got = sorted((r.a, r.b) for r in matching.similarity_join(d, "s", t, "blk").collect())
        pairs = d.alias("x").join(d.alias("y"), F.expr("x.blk = y.blk and x.record_id < y.record_id")).where(X.trigram_similarity(F.col("x.s"), F.col("y.s")) >= t)
        assert got == sorted((r[0], r[1]) for r in pairs.select("x.record_id", "y.record_id").collect())


def test_similarity_stars_join_what_all_pairs_join(spark, monkeypatch):
    monkeypatch.setattr(matching, "SLICE", 3)
    test_similarity_join_equals_all_pairs(spark)
    rows = [(i, "x", ("ferreteria norte", "ferreteria nortes", "casa sur")[i % 3]) for i in range(30)]
    d = spark.createDataFrame(rows, "record_id long, blk string, s string")
    groups = [{r.node: r.component for r in components.connected_components(matching.similarity_join(d, "s", 0.7, "blk", pairs=p)).collect()} for p in ("all", "star")]
    assert groups[0] == groups[1] and matching.similarity_join(d, "s", 0.7, "blk", pairs="star").count() == 28


def test_strings_that_all_blocks_share_are_compared_once(spark, monkeypatch):
    """The same pairs as block by block; strings of all blocks meet in one comparison, of single blocks in theirs."""
    rng, seen = random.Random(9), []
    real = matching._similar_strings
    monkeypatch.setattr(matching, "_similar_strings", lambda t, at: (seen.append(t.count()), real(t, at))[1])
    words = [f"{a} {b}" for a in ("ferro", "ferros", "casa", "casas") for b in ("norte", "nortes", "sur")]
    shared = [(i, str(i % 20), words[i // 20 % 12]) for i in range(480)]
    own = [(i, str(i), rng.choice(words) + f" {i}{i}{i}") for i in range(40)]
    for rows, most in ((shared, 12), (own, 40)):
        d = spark.createDataFrame(rows, "record_id long, blk string, s string")
        got = sorted((r.a, r.b) for r in matching.similarity_join(d, "s", 0.6, "blk").collect())
        pairs = d.alias("x").join(d.alias("y"), F.expr("x.blk = y.blk and x.record_id < y.record_id")).where(X.trigram_similarity(F.col("x.s"), F.col("y.s")) >= 0.6)
        assert got == sorted((r[0], r[1]) for r in pairs.select("x.record_id", "y.record_id").collect())
        assert seen.pop() == most


def test_exact_pairs_are_counted_without_making_them(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["casa norte", "casa sur", "sol"]), rng.choice(["x", "y"]), rng.choice([None, "", "900000001", "900000002"]), rng.choice([None, "a@b.co"]), rng.choice([None, "3001234567", "300"]), rng.choice([None, "r1", "r2"])) for i in range(60)]
    d = spark.createDataFrame(rows, "record_id long, name_norm string, place_norm string, key_nit string, email_norm string, phone_norm string, register_id string")
    found = matching.resolve_rules([matching.match_on(d, k, r, s, guard=g) for r, k, s, g in matching.EXACT_RULES])
    assert {r.rule for r in found.collect()} >= {"register_id", "nit", "name_place"}
    c = golden.cluster_records(d, found)
    want = {r.entity: r.n_matches for r in quality.matches_per_entity(c, found).collect()}
    assert {r.entity: r.n_matches for r in quality.matches_per_entity(c, found.limit(0), stars=True).collect()} == want and max(want.values()) > 100


def test_near_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, 4.6 + rng.random() * 0.004, -74.1 + rng.random() * 0.004) for i in range(150)] + [(900, 0.0, 0.0), (901, 0.0, 0.0), (902, None, 1.0)]
    d = spark.createDataFrame(rows, "record_id long, lat double, lon double")
    got = sorted((r.a, r.b) for r in matching.near_pairs(d).collect())
    far = d.alias("x").join(d.alias("y"), F.expr("x.record_id < y.record_id and abs(x.lat - y.lat) < 0.001 and abs(x.lon - y.lon) < 0.001 and x.lat != 0"))
    want = far.where(X.distance_m(F.col("x.lat"), F.col("x.lon"), F.col("y.lat"), F.col("y.lon")) < 50).select("x.record_id", "y.record_id")
    assert got == sorted(map(tuple, want.collect())) and got
    assert (900, 901) in {(r.a, r.b) for r in matching.near_pairs(d, null_island="keep").collect()}


def test_review_and_verdicts(spark):
    m = spark.createDataFrame([(1, 2, "similar_address", 70, "pending"), (1, 3, "similar_name", 75, "pending"), (2, 3, "nit", 100, "auto_match")], "a long, b long, rule string, score int, decision string")
    assert [(r.a, r.b) for r in matching.review_candidates(m).collect()] == [(1, 2)]
    v = spark.createDataFrame([(1, 2, "same", "r", 0.9), (1, 3, "error", "r", 0.1)], "a long, b long, verdict string, reason string, confidence double")
    out = matching.apply_verdicts(m, v)
    assert {(r.a, r.b): r.decision for r in out.collect()} == {(1, 2): "ia_match", (1, 3): "pending", (2, 3): "auto_match"}
    assert matching.confirmed(out).count() == 2 and matching.match_stats(out).first().total == 3


def test_best_match(spark):
    p = spark.createDataFrame([(1, "Ferretería Sol", "Cra 1 # 2-3", "Cali"), (2, "Ferreteria Sola SAS", "Cra 1 # 2-3", "Cali"), (3, "Nada", None, "Cali"), (4, "Ferreteria Sol", "x", "Tunja")], "prospect_id long, name string, address string, place string")
    c = spark.createDataFrame([("a", "SOL FERRETERIA", "Carrera 1 2 3", "CALI", 0), ("b", "SOL FERRETERIA", "otra", "CALI", 1)], "code string, account string, address string, place string, seq long")
    got = {r.prospect_id: (r.category, r.code) for r in contrast.best_match(p, c).collect()}
    assert got == {1: ("confirmed", "a"), 2: ("probable", "a"), 3: ("new", None), 4: ("new", None)} or got[2][0] == "confirmed" and got[1] == ("confirmed", "a")
    assert contrast.unmatched_customers(c, contrast.best_match(p, c)).count() == 0
    k = contrast.kpis(contrast.best_match(p, c)).first()
    assert k.total == 4 and k.coverage == 50.0 and contrast.kpis(contrast.best_match(p.limit(0), c)).first().coverage == 0.0


def test_place_index_equals_all_pairs(spark, monkeypatch):
    """Short and long names, one-letter names, names within names: every best match from 72 on is found."""
    from tests.plain_ratios import wratio

    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcd-ab") for _ in range(n)).strip("-").replace("--", "-")
    known = sorted({w for n in (1, 2, 3, 4, 5, 7, 9, 12, 20) for _ in range(6) if (w := word(n))})
    asked = sorted({w for n in (1, 2, 3, 4, 5, 6, 8, 10, 14, 25) for _ in range(12) if (w := word(n))} - set(known))
    k = spark.createDataFrame([(w, f"d{i % 2}") for i, w in enumerate(known)], "slug string, department string")
    r = spark.createDataFrame([(i, w, f"d{i % 3}" if i % 4 else None) for i, w in enumerate(asked)], "id long, place string, department string")
    for by in (False, True):
        got = {x.id: (x.slug, x.score) for x in places.resolve_places(r, k, by_department=by).collect()}
        for i, w in enumerate(asked):
            some = [s for j, s in enumerate(known) if not by or i % 4 == 0 or j % 2 == i % 3]
            score, best = max(((round(wratio(w, s), 9), s) for s in some), key=lambda t: (t[0], [-ord(c) for c in t[1]] + [1]), default=(0, None))
            slug, found = got[i]
            assert (slug, round(found, 9)) == ((best, score) if score >= 72 else (None, 0.0)), (w, best, score, got[i])


def test_places(spark):
    known = spark.createDataFrame([("bogota", "cundinamarca"), ("medellin", "antioquia"), ("la-union", "narino"), ("la-union", "valle")], "slug string, department string")
    asked = spark.createDataFrame([(1, "Bogotá"), (2, "Medelin"), (3, "zzz"), (4, None), (5, "")], "id long, place string")
    got = {r.id: (r.how, r.slug) for r in places.resolve_places(asked, known).collect()}
    assert got == {1: ("exact", "bogota"), 2: ("fuzzy_high", "medellin"), 3: ("rejected", None), 4: ("rejected", None), 5: ("rejected", None)}
    texts = spark.createDataFrame([(1, "Bogotá y Medellín, bogota; de"), (2, "tienda en bogota")], "id long, text string")
    assert sorted((r.id, r.slug) for r in places.parse_places(texts, known).collect()) == [(1, "bogota"), (1, "medellin"), (2, "bogota")]
    depts = places.resolve_departments(spark.createDataFrame([(1, "Antioquía")], "id long, department string"), known)
    assert [(r.id, r.slug) for r in depts.collect()] == [(1, "medellin")]


def test_coverage_credits_both_departments(spark):
    want = spark.createDataFrame([("La Unión", "Nariño", 1), ("La Unión", "Valle", 2), ("Cali", "Valle", 3), ("cali ", "valle", 4)], "place string, department string, seq int")
    got = coverage.coverage(want, {"a": spark.createDataFrame([("la unión",), ("LA UNIÓN ",)], "place string"), "b": spark.createDataFrame([], "place string")}).collect()
    assert sorted((r.place, r.total) for r in got) == [("La Unión", 2), ("La Unión", 2), ("cali ", 0)]


def test_flatten_branches_places_register_owners(spark):
    pages = [{"name": "A", "mainPhone": {"phoneToShow": "1"}, "allAddresses": [{"addressLocality": "Cali", "streetName": "Cra", "streetNumber": "5", "latitude": "4.5"}, {"mainAddressName": "Sur", "streetName": "Atiende en casa"}], "emails": ["e@x.co"]},
             {"name": "B", "mainAddress": {"streetName": "Cl 3", "allPhonesList": [{"phoneToShow": "9"}, {"number": "8"}]}, "allAddresses": []}]
    d = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)], "id int, payload string")
    assert [(r.name, r.branch, r.address, r.phone, r.lat) for r in flatten.flatten_branches(d).orderBy("id").collect()] == [("A", "Cali", "Cra 5", "1", 4.5), ("B", "Principal", "Cl 3", "9 / 8", 0.0)]
    place = [{"fsq_place_id": "p", "name": "N", "location": {"region": "R"}, "categories": [{"id": "1", "name": "x"}, {"id": "2", "name": "y"}], "date_refreshed": "2024-01-02"}, {"name": "no id"}]
    p = flatten.flatten_place(spark.createDataFrame([(json.dumps(x), "Cali", None) for x in place], "payload string, search_city string, extracted timestamp"), {"cali": "Valle"}).collect()
    assert [(r.place, r.department, r.categories, str(r.refreshed)[:10]) for r in p] == [("Cali", "Valle", "x, y", "2024-01-02")]
    reg = spark.createDataFrame([("R", "", "f", "300 1234567", "20230115", json.dumps([{"RAZON_SOCIAL": "o1"}, {"RAZON_SOCIAL": "o2"}]))], "razon_social string, mun_comercial string, mun_fiscal string, telefono string, fecha_matricula string, owners string")
    r = flatten.flatten_register(reg).first()
    assert (r.name, r.place, r.phone, str(r.fecha_matricula)) == ("R", "f", "+573001234567", "2023-01-15")
    assert flatten.flatten_owners(reg).first().owner == "o1" and flatten.flatten_owners(reg, every=True).count() == 2


def test_page_contacts(spark):
    html = "<head><meta name='description' content='d'></head><a href='/x'>Nada</a><a href='c.html'>Contáctanos contacto</a> v@x.co tel 604 444 5566 https://wa.me/573001112233"
    d = spark.createDataFrame([(1, "http://a.co/i", html), (2, "http://b.co", None)], "page_id long, url string, html string")
    r = {x.page_id: x for x in webpages.contacts_of(d).collect()}
    assert (r[1].description, r[1].contact, r[1].email, r[1].whatsapp) == ("d", "http://a.co/c.html", "v@x.co", "https://wa.me/573001112233") and r[2].email is None


def test_log_insert_upsert_stream(spark, tmp_path):
    log, table = tmp_path / "log", str(tmp_path / "table")
    log.mkdir()
    write = lambda n, rows: (log / n).write_text("\n".join(json.dumps(r) for r in rows) + "\nnot json\n")
    write("a.json", [{"tipo": "detalle", "id_rm": "1", "ts": "2"}, {"tipo": "detalle", "id_rm": "1", "ts": "1"}, {"tipo": "busqueda", "id_rm": "9"}])
    assert tables.read_log(spark, str(log), "detalle").count() == 2
    run = lambda: stream.ingest(spark, str(log), tables.LOG_SCHEMA, lambda b: b.where("tipo = 'detalle'").select("id_rm", "ts"), table, str(tmp_path / "check"), ["id_rm"], ["ts"]).awaitTermination(120)
    run()
    write("b.json", [{"tipo": "detalle", "id_rm": "1", "ts": "0"}, {"tipo": "detalle", "id_rm": "2", "ts": "3"}])
    run()
    assert sorted((r.id_rm, r.ts) for r in spark.read.parquet(table).collect()) == [("1", "1"), ("2", "3")]
    out = stream.bounded_dedup(spark.readStream.schema("h string, t timestamp").json(str(log)), "t", ["h"], "1 hour")
    assert out.isStreaming


def files_of(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_scanned_pages_equal_the_parser(spark):
    """Random heads and links: what the patterns say they can read is what the parser reads."""
    rng = random.Random(6)
    parts = ["<meta name='description' content=\"a 'b' c\">", '<META content="og" property=og:description>', '<meta name=description content="">', '<meta name="x" content="name=description">', "<a href='/contacto'>x</a>", '<a  class="k" href=contact.html >y<b>z</b></a>', '<a href="//h.co/contact">x</a>',
             '<a href="../contact">x</a>', '<a href="#x">Contáctanos contactanos</a>', "<a name=q>contact</a>", '<a href="http://q.co/z?a=1&amp;b=2">ATENCION</a>', "<!-- <a href='/contact'>no</a> -->", "<script>'<a href=\"/contact\">'</script>", "<title><meta name=description content=no></title>", "text contact &amp; more", '<a href="/u" title="a>b">contact</a>',
             '<a href="/one">un<a href="/contact/two">dos</a>', "<a href='/broken>contact</a>", "<p>", '<a href="mailto:contact@x.co">m</a>', '<meta name="description" content="t &eacute;">', "<a href='/q'>", "\n"]
    rows = [(i, rng.choice(["http://a.co/i", "https://b.co", "http://c.co/d/e.html?x=/y", "bad", None]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(600)] + [(9000, "http://a.co", None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    both = d.select("page_id", "html", "url", webpages.scanned_facts(F.col("url"), F.col("html")).alias("s"), webpages.page_facts("url", "html").alias("p")).collect()
    for r in both:
        assert not r.s.read or (r.s.description, r.s.contact) == (r.p.description, r.p.contact), r
    assert sum(r.s.read for r in both) > 200 and sum(r.s.read and r.s.contact is not None for r in both) > 40
    want = {r.page_id: (r.p.description, r.p.contact) for r in both}
    assert {r.page_id: tuple(r.f) for r in webpages.with_facts(d).collect()} == want


def test_relational_read(spark):
    """Range reads of the database that Spark ships with: bounds from the table, rows with a null column, empty tables."""
    import os
    import uuid

    url = f"jdbc:derby:memory:t{uuid.uuid4().hex}"
    spark._jvm.System.setProperty("derby.stream.error.file", os.devnull)
    d = spark.createDataFrame([(i, f"n{i}") for i in range(-5, 95)] + [(None, "none")], "id int, name string")
    d.write.format("jdbc").options(url=url + ";create=true", dbtable="t", createTableColumnTypes="name VARCHAR(20)").save()
    got = tables.read_table(spark, url, "t", "id", 4)
    assert got.rdd.getNumPartitions() == 4 and sorted(r.name for r in got.collect()) == sorted(r.name for r in d.collect())
    assert max(r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 35
    assert tables.read_table(spark, url, "t", "id", 4, low=0, high=10).count() == 101
    d.where("id is null").write.format("jdbc").options(url=url, dbtable="e", createTableColumnTypes="name VARCHAR(20)").save()
    assert tables.read_table(spark, url, "e", "id", 4).count() == 1


def test_pages_join_to_the_whole_order(spark):
    rows = [(i, (i * 7) % 5 if i % 6 else None) for i in range(60)]
    d = spark.createDataFrame(rows, "k long, s int")
    want, got, last = [(r.k, r.s) for r in d.orderBy(F.desc_nulls_last("s"), "k").collect()], [], None
    while some := reports.page_after(d, "s", "k", 7, last).collect():
        got += [(r.k, r.s) for r in some]
        last = (some[-1].s, some[-1].k)
    assert got == want


def test_crowded_cells_give_the_same_pairs(spark):
    """A crowd in one cell and around it, names that repeat, points at the edges, blanks."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(4))
    spot = lambda: (4.6 + rng.gauss(0, 0.0004), -74.1 + rng.gauss(0, 0.0004))
    rows = [(i, *spot(), f"{word()} {word()} {rng.choice(['sol', 'luna'])}") for i in range(500)] + [(i, *spot(), rng.choice(["", None, "sol luna"])) for i in range(500, 560)]
    rows += [(600, 0.0, 0.0, "sol luna"), (601, 0.0, 0.0, "sol luna"), (602, None, 1.0, "sol luna")]
    d = spark.createDataFrame(rows, "record_id long, lat double, lon double, name_norm string")
    few, many = ({(r.a, r.b) for r in matching.near_names(d, crowded=n).collect()} for n in (20, 10_000))
    assert few == many and len(few) > 100
    assert matching.near_names(d, crowded=20).groupBy("a", "b").count().where("count > 1").isEmpty()


def test_one_cell_of_many_points(spark):
    """50,000 points of one cell, each name twice: no task meets them all."""
    d = spark.range(50_000).select(F.col("id").alias("record_id"), (F.lit(4.6001) + F.rand(1) * 1e-4).alias("lat"), (F.lit(-74.0999) + F.rand(2) * 1e-4).alias("lon"), F.substring(F.sha2((F.col("id") % 25_000).cast("string"), 256), 1, 14).alias("name_norm"))
    assert matching.near_names(d).count() == 25_000


def test_conflict_classes(spark):
    rows = [(i, "n1", "phone A" if i % 2 else "phone B", "x", "s") for i in range(1000)] + [(2000, "n2", "c", "x", "s"), (2001, "n2", "c", None, "s"), (2002, " ", "d", "e", "s"), (2003, " ", "f", "e", "s"), (2004, None, "f", "e", "s")]
    d = spark.createDataFrame(rows, "record_id long, nit string, phone string, place string, source string")
    fields = {"phone": "phone", "place": "place"}
    got = quality.conflict_classes(d, fields).collect()
    assert [(r.nit, r.field, r.n_values, r["values"], r.n_records) for r in got] == [("n1", "phone", 2, ["phone A", "phone B"], 1000)]
    assert quality.detect_conflicts(d, fields).count() == 1000
    want = {tuple(r) for r in quality.conflict_summary(quality.detect_conflicts(d, fields)).collect()}
    assert {tuple(r) for r in quality.conflict_summary(quality.conflict_classes(d, fields)).collect()} == want and (None, None, 1000, 3) in want


def test_keyed_insert_survives_failures(spark, tmp_path, monkeypatch):
    """A batch that fails between the folders it writes, leaving some in place, is repeated: no row twice, none lost."""
    table, log = tmp_path / "t", tmp_path / "log"
    log.mkdir()
    write = lambda n, ids: (log / n).write_text("\n".join(json.dumps({"k": f"k{i}", "n": i}) for i in ids))
    run = lambda: stream.ingest(spark, str(log), "k string, n long", lambda b: b, str(table), str(tmp_path / "check"), ["k"], ["n"], buckets=8).awaitTermination(120)
    write("a.json", [*range(40), *range(20)])
    run()
    before = files_of(table)
    write("b.json", range(30, 90))
    real = keyed._write

    def half(d, path, by):
        real(d.where("bucket < 4"), path, by)
        raise OSError("lost")

    monkeypatch.setattr(keyed, "_write", half)
    with pytest.raises(Exception, match="lost"):
        run()
    assert len(files_of(table)) > len(before)
    monkeypatch.setattr(keyed, "_write", real)
    run()
    got = keyed.read(spark, str(table), spark.createDataFrame([], "k string, n long").schema)
    assert sorted((r.k, r.n) for r in got.collect()) == sorted((f"k{i}", i) for i in range(90))
    assert before.items() <= files_of(table).items() and keyed.bucket_count(spark, str(table)) == 8


def test_upsert_leaves_other_buckets(spark, tmp_path):
    table = tmp_path / "t"
    d = spark.createDataFrame([(i, f"a{i}", i) for i in range(200)], "k long, name string, n long")
    keyed.upsert_into(d, str(table), ["k"], ["n"], buckets=16)
    before = files_of(table)
    new = spark.createDataFrame([(7, "x", 70), (7000, "y", 1)], "k long, name string, n long")
    keyed.upsert_into(new, str(table), ["k"], ["n"])
    after = files_of(table)
    touched = {n.split("/")[0] for n in after.keys() - before.keys()}
    assert 1 <= len(touched) <= 2 and {n for n in before if n.split("/")[0] not in touched} == {n for n in before if n in after and before[n] == after[n]}
    rows = {r.k: (r.name, r.n) for r in keyed.read(spark, str(table), d.schema).collect()}
    assert len(rows) == 201 and rows[7] == ("a7", 70) and rows[7000] == ("y", 1) and rows[8] == ("a8", 8)


def test_first_of_ties_nulls_and_lone_keys(spark):
    d = spark.createDataFrame([("a", 2, "x"), ("a", None, "y"), ("b", 1, None), (None, 0, "z")], "k string, n int, v string")
    assert sorted((r.k, r.n, r.v) for r in tables.first_of(d, ["k"], ["n"]).collect()) == [("a", None, "y"), ("b", 1, None)]
    assert [r.k for r in tables.first_of(d.select("k"), ["k"], ["k"]).orderBy("k").collect()] == ["a", "b"]


def test_geo(spark):
    d = spark.createDataFrame([(1, "Cali", 3.4, -76.5), (2, "Cali", 10.0, -75.0), (3, "Nada", 50.0, 0.0), (4, "cali", None, None)], "id int, place string, lat double, lon double")
    c = spark.createDataFrame([("CALI", 3.45, -76.53)], "place string, lat double, lon double")
    assert {r.id: r.snapped for r in geo.snap_to_centres(d, c).collect()} == {1: False, 2: True, 3: False, 4: False}
    assert {r.id: r.lat for r in geo.with_fallback(d, c).collect()} == {1: 3.4, 2: 10.0, 4: 3.45}
    assert geo.density(d, 0.5).count() == 2
    cache = spark.createDataFrame([("k1", 1.0, 2.0)], "key string, lat double, lon double")
    asked = spark.createDataFrame([("k1", "a", "p", "d"), ("k2", "a", "p", "d")], "code string, address string, place string, department string")
    assert geo.pending_geocodes(asked, cache).first().pending == 1


def test_reports_write(spark, resolved, tmp_path):
    reports.csv_entities(resolved.entities, str(tmp_path / "e"))
    assert spark.read.csv(str(tmp_path / "e"), header=True).count() == resolved.entities.count()
    reports.csv_listings(spark.createDataFrame([("v", "p", ["a", "b"], 1, True), ("w", "p", [], 2, False)], "department string, place string, cats array<string>, score int, approved boolean"), str(tmp_path / "l"), True)
    assert spark.read.csv(str(tmp_path / "l"), header=True).first().cats == "a, b"
    r = reports.run_report(resolved.records, resolved.matches, resolved.entities).first()
    assert r.matches.total == resolved.matches.count() and r.entities.total == resolved.entities.count()
    nested = reports.nested_matches(matching.hydrate(resolved.matches, resolved.records, ["name"]), ["name"]).first()
    assert nested.record_a.name and nested.score == 100
    (tmp_path / "c.csv").write_text("Código de cliente , Nombre de la cuenta,Población\n1,A,Cali\n1,B,\n")
    c = contrast.dedup_customers(contrast.read_customers(spark, str(tmp_path / "c.csv"))).collect()
    assert [(x.code, x.account, x.place, x.mobile) for x in c] == [("1", "A", "Cali", "")]


RULE_COLUMNS = "record_id long, name_norm string, place_norm string, key_nit string, email_norm string, phone_norm string, register_id string"


def rule_rows(spark):
    rng = random.Random(18)
    rows = [(i, rng.choice(["casa norte", "casa nortes", "sol", None]), rng.choice(["x", "y"]), rng.choice([None, "", "900000001", "900000002"]), rng.choice([None, "", "a@b.co"]), rng.choice([None, "3001234567", "300"]), rng.choice([None, "", "r1", "r2"])) for i in range(70)]
    return spark.createDataFrame(rows, RULE_COLUMNS)


def test_exact_matches_have_their_first_rule_without_a_shuffle_of_pairs(spark):
    d = rule_rows(spark)
    want = matching.resolve_rules([matching.match_on(d, k, r, s, guard=g) for r, k, s, g in matching.EXACT_RULES])
    got = matching.exact_matches(d, keep=["email_norm"])
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    both = {(r.a, r.b): (r.a_email_norm, r.b_email_norm) for r in got.collect()}
    email = {r.record_id: r.email_norm for r in d.collect()}
    assert all(v == (email[a], email[b]) for (a, b), v in both.items())
    stars = {tuple(r) for r in matching.exact_matches(d, "star").collect()}
    assert {s[:2] for s in stars} <= set(both)


def test_resolution_finds_review_links_when_they_are_read(spark, monkeypatch):
    calls = []
    real = matching.similarity_join
    monkeypatch.setattr(matching, "similarity_join", lambda *a, **b: (calls.append(1), real(*a, **b))[1])
    r = resolve(spark.createDataFrame(corpus(), RAW))
    assert r.entities.count() > 0 and not calls
    assert r.matches.where("decision = 'pending'").count() > 0 and calls


def test_entity_statistics_make_no_pairs(spark, monkeypatch):
    from entityspark import queries

    kinds = []
    real = matching.match_on
    monkeypatch.setattr(matching, "match_on", lambda *a, pairs="all", **b: (kinds.append(pairs), real(*a, pairs=pairs, **b))[1])
    got = queries.QUERIES["a4_a8_entity_stats"](spark, "/root/testdata/sf0.001")
    assert got.where("n_matches != n_first").isEmpty() and set(kinds) == {"star"}


def test_equal_names_are_compared_once(spark, tmp_path, monkeypatch):
    """Copies of a table under shifted keys have the same pairs of neighbours, but for the seams."""
    from entityspark import queries

    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    n, sizes = part.count(), []
    for i in range(5):
        part.withColumn("p_partkey", F.col("p_partkey") + i * n).write.mode("append").parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(queries, "spread", lambda d: (sizes.append((d.columns, d.count())), d)[1])
    assert queries.QUERIES["t30_fuzzy_ratios"](spark, str(tmp_path)).count() == 5 * n - 1
    assert [c for names, c in sizes if names == ["x", "y"]][0] <= n + 4


def test_similar_names_without_exact_pairs(spark):
    d = rule_rows(spark)
    known = matching.resolve_rules([matching.match_on(d, k, r, s, guard=g) for r, k, s, g in matching.EXACT_RULES])
    want = matching.hydrate(matching.unmatched(matching.similar_names(d), known), d, ["name_norm"])
    got = matching.similar_names_only(d, ["name_norm"]).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 10


def test_match_report_is_packed_and_read_back(spark, monkeypatch, tmp_path):
    from entityspark import queries

    monkeypatch.setattr(queries, "scratch_path", lambda s: str(tmp_path / "report"))
    assert queries.QUERIES["s6_nested_reports"](spark, "/root/testdata/sf0.01").count() == 1158
    assert list((tmp_path / "report").glob("*.json.gz")) and not list((tmp_path / "report").glob("*.json"))


def test_conflict_report_grows_with_its_records(spark, tmp_path):
    """All records of one number, each with another name: the report has each value once."""
    sizes = []
    for n in (400, 800):
        d = spark.createDataFrame([(i, "900000001", f"nombre {i * 7919 % 99991} {i}", "rues") for i in range(n)], "record_id long, nit string, name string, source string")
        fields, path = {"name": "name"}, tmp_path / str(n)
        reports.write_conflicts(quality.conflict_classes(d, fields), d, ["name", "source"], str(path))
        sizes.append(sum(f.stat().st_size for f in path.rglob("part-*")))
        got = reports.read_conflicts(quality.conflict_classes(d, fields), d, ["name", "source"], str(path))
        want = reports.nested_conflicts(quality.detect_conflicts(d, fields), d, ["name", "source"], cap=None)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and got.count() == n
    assert sizes[1] < 2.5 * sizes[0]


def test_records_and_links_are_written_before_they_are_read_again(spark, monkeypatch):
    from entityspark import queries

    written = []
    real = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda d: (written.append(d.columns), real(d))[1])
    assert queries.QUERIES["j17_review"](spark, "/root/testdata/sf0.001").count() > 0
    assert ["a", "b", "rule", "score", "decision"] in written
    queries.QUERIES["j2_exact_links"](spark, "/root/testdata/sf0.001").count()
    assert written[-1] == ["record_id", "name_norm", "place_norm", "key_nit", "email_norm", "phone_norm"]

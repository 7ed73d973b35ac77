"""Golden rows of the scalar functions."""

import random

import pytest
from pyspark.sql import functions as F

from entityspark.functions import ratios as R
from tests import plain_ratios
from entityspark.functions import scoring as S
from entityspark.functions import text as X


def check(spark, f, rows):
    d = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, v string")
    assert [r[0] for r in d.orderBy("i").select(f(F.col("v")).alias("x")).collect()] == [w for _, w in rows]


GOLDEN = {
    # legal forms at any place, dotted or not, signs between words, words that only look like a form
    "normalize_name": (X.normalize_name, [("  Pinturas   Río-Verde (Sede 2) LIMITADA", "pinturas rio verde sede 2"), ("Cía. Tornillos: Ñandú; S.A.", "tornillos nandu"), ("sastre y saldos", "sastre y saldos"),
                                          ("E.U. Clavos*Clavos", "clavos clavos"), ("ltda sas", None), ("-", None), ("\t", None), (None, None)]),
    # prefixes with and without a plus, a short number that begins like one, letters, too few and too many digits
    "normalize_phone": (X.normalize_phone, [("+57(311)222-33-44", "3112223344"), ("5716543210", "5716543210"), ("57 1 654 32 10 9", "16543210" + "9"), ("tel 765 43 21", "7654321"), ("00 57 320 555 66 77", "3205556677"), ("12-34-56", None), ("+57 1234", None), (None, None)]),
    "normalize_phone_bulk": (X.normalize_phone_bulk, [("3157001122", "31001122"), ("+57 300 1234567", "3001234567"), ("5757575", None), (None, None)]),
    "normalize_email": (X.normalize_email, [("  X.Y+z%1@Sub-1.Tienda.MX ", "x.y+z%1@sub-1.tienda.mx"), ("a@b", None), ("a b@c.de", None), ("ñ@c.de", None), ("a@c.d3", None), ("@c.de", None), ("a@@c.de", None), (None, None)]),
    "normalize_address": (X.normalize_address, [("KR 7  Nro. 8-9", "carrera 7 # 8-9"), ("Clle 3 Dg 4 Tv 5", "calle 3 diagonal 4 transversal 5"), ("Avda. Óvalo Numero 6", "avenida. ovalo # 6"), ("crack av", "crack avenida"), (" ", None), (None, None)]),
    "classify_phone": (X.classify_phone, [("3001234567", "mobile"), ("6044445566", "landline"), ("6001234567", "landline"), ("123456", "unknown"), (None, "unknown")]),
    "chamber_to_city": (X.chamber_to_city, [("FLORENCIA PARA EL CAQUETA", "florencia"), ("MEDELLIN PARA ANTIOQUIA", "medellin"), ("SUR Y ORIENTE DEL TOLIMA", "tolima"), ("SINCELEJO", "sincelejo"), (None, None)]),
    "domain_of": (X.domain_of, [("https://www.ferreteria.com/page", "ferreteria.com"), ("http://u@h.co:80?x", "u@h.co:80"), ("nada", "")]),
    "canonical_url": (X.canonical_url, [("https://a.co/x?y=1?z", "https://a.co/x"), (None, None)]),
    "parse_yyyymmdd": (lambda c: X.parse_yyyymmdd(c).cast("string"), [("20230115", "2023-01-15"), ("99991231", None), ("0", None), ("2023-02-01", "2023-02-01"), ("20231399", None), ("x", None), (None, None)]),
    "slug": (lambda c: X.normalize_place(c, "slug"), [("Bogotá D.C.", "bogota-dc"), (" Santa  Marta_ ", "santa-marta"), ("¡!", "")]),
    "upper": (lambda c: X.normalize_place(c, "upper"), [("San-José, ", "SAN JOSE"), (None, "")]),
    "name_upper": (X.normalize_name_upper, [("Peña & Cía.", "PENA CIA"), (None, ""), (" ", "")]),
    "address_upper": (X.normalize_address_upper, [("cra 5 #10-20 apto 3", "CARRERA 5 10 20 APARTAMENTO 3"), (None, "")]),
    "title": (lambda c: X.slug_to_title(c, {"bogota": "Bogotá"}), [("bogota", "Bogotá"), ("santa-marta", "Santa Marta")]),
    "html": (X.html_to_text, [("<p>a&amp;b<br/>c</p>\n\n\n\nd", "a&b\nc \n\nd"), (None, None)]),
    "to_coordinate": (X.to_coordinate, [("4.6", 4.6), ("", 0.0), ("x", 0.0), (None, 0.0)]),
    "e164": (X.phone_e164, [("57 3001234567", "+573001234567"), ("300 1234567", "+573001234567"), ("6041234567", "6041234567"), (None, None)]),
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden(spark, name):
    check(spark, *GOLDEN[name])


def test_two_part_results(spark):
    d = spark.createDataFrame([("(+57) 300 8730567 / (+57) 604 3222637", "https://maps.example/@1.5,-2.5,17z", "x!3d4.25!4d-74.5")], "p string, u string, v string")
    r = d.select(X.split_phones(F.col("p")).alias("p"), X.coordinates_from_url(F.col("u")).alias("u"), X.coordinates_from_url(F.col("v")).alias("v"), X.derive_whatsapp(F.col("p"), F.lit("https://wa.me/573001112233")).alias("w")).first()
    assert tuple(r.p) == ("+573008730567", "+576043222637") and tuple(r.u) == (1.5, -2.5) and tuple(r.v) == (4.25, -74.5) and r.w == "+573001112233"


def test_similarity_compares_in_single_precision(spark):
    d = spark.createDataFrame([("", ""), ("abc", "abc"), ("abc def", "def abc"), ("abc", None)], "a string, b string")
    assert [r[0] for r in d.select(X.trigram_similarity(F.col("a"), F.col("b"))).collect()][:3] == [0.0, 1.0, 1.0]
    sets = spark.range(1).select(X.set_similarity(F.sequence(F.lit(1), F.lit(7)), F.sequence(F.lit(1), F.lit(10))).alias("x")).first().x
    assert sets < 0.7 and abs(sets - 0.7) < 1e-6


def test_scores(spark):
    d = spark.createDataFrame([("Ferretería y cemento", "hardware"), ("Droguería cemento", "hardware"), (None, None)], "n string, f string")
    r = d.select(S.osm_score(F.col("n"), F.col("f")).alias("o"), S.maps_score(F.col("n"), F.array(), F.lit(None).cast("string")).alias("m")).collect()
    assert [x.o for x in r] == [9, -5, 0] and [x.m for x in r] == [5, 3, 0]


def test_ratios(spark):
    """All ratios against plain Python: short and long strings, several integers of bits, repeats, blanks, empties, nulls."""
    rng = random.Random(1)
    word = lambda n, letters="abc ": "".join(rng.choice(letters) for _ in range(n))
    rows = [(word(rng.randint(0, 12)), word(rng.randint(0, 12))) for _ in range(120)] + [(word(rng.randint(50, 140), "abcdé 😀"), word(rng.randint(50, 140), "abcdé 😀")) for _ in range(12)]
    rows += [(word(n), word(m)) for n in (61, 62, 63, 124, 125) for m in (62, 63, 130)] + [("a" * 200, "a" * 130), ("", ""), ("", "x"), ("a b c", "c a b"), ("abc", "xxabcxx"), ("a\u00a0b", "b a"), ("bogota", "bogota"), ("a b c d", "a b"), ("casa norte", "norte casa blanca de la montana azul")]
    d = spark.createDataFrame(rows + [(None, "a"), ("a", None), (None, None)], "a string, b string")
    names = ("lcs", "ratio", "token_sort", "partial", "token_set", "wratio")
    got = d.select("a", "b", *(getattr(R, n)(F.col("a"), F.col("b")).alias(n) for n in names)).collect()
    for r in got:
        for n in names[1:] if r.a is None or r.b is None else names:
            want = None if r.a is None or r.b is None else getattr(plain_ratios, n)(r.a, r.b)
            assert r[n] == want or abs(r[n] - want) < 1e-9, (n, r)
    by = {(r.a, r.b): r for r in got}
    assert by["a b c", "c a b"].token_sort == 100 and by["abc", "xxabcxx"].partial == 100 and by["bogota", "bogota"].wratio == 100

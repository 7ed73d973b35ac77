"""Normalisers of names, phones, e-mails, addresses, places, dates and urls, as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal words and street abbreviations of the directory sources, and the parse lists below.
LEGAL_WORDS = ["sas", "sas.", "s.a.s", "ltda", "limitada", "sa", "s.a", "cia", "compania", "compañia", "sociedad", "anonima",
               "eirl", "spa", "asociacion", "empresa", "eu", "e.u"]
LEGAL_WORDS_BULK = ["sas", "sa", "ltda", "limitada", "cia", "compania", "spa", "eirl", "eu", "empresa", "asociacion"]
STREETS = [(r"\bcra\b", "carrera"), (r"\bcr\b", "carrera"), (r"\bkr\b", "carrera"), (r"\bcl\b", "calle"), (r"\bclle\b", "calle"), (r"\bcll\b", "calle"),
           (r"\bav\b", "avenida"), (r"\bavda\b", "avenida"), (r"\bdg\b", "diagonal"), (r"\btv\b", "transversal"),
           (r"\bno\.\s*", "# "), (r"\bnro\.\s*", "# "), (r"\bnum\.\s*", "# "), (r"\bnumero\b", "#")]
STREETS_UPPER = [(r"\bCRA?\.?\b", "CARRERA"), (r"\bCLL?\b\.?", "CALLE"), (r"\bCL\b\.?", "CALLE"), (r"\bTV\b\.?", "TRANSVERSAL"), (r"\bTRANSV\.?\b", "TRANSVERSAL"),
                 (r"\bAVDAS?\b\.?", "AVENIDA"), (r"\bAV\b\.?", "AVENIDA"), (r"\bDIAG\.?\b", "DIAGONAL"), (r"\bDG\b\.?", "DIAGONAL"), (r"\bMZ\b\.?", "MANZANA"),
                 (r"\bBRR?IO?\b\.?", "BARRIO"), (r"\bKM\b\.?", "KILOMETRO"), (r"\bVDA\b\.?", "VEREDA"), (r"\bAP(TO|T)?\b\.?", "APARTAMENTO"), (r"\bLT\b\.?", "LOTE"),
                 (r"\bBLQ?\b\.?", "BLOQUE"), (r"\bCS(A)?\b\.?", "CASA"), (r"\bED(F|IF)?\b\.?", "EDIFICIO"), (r"\bPISO\b", "PISO"), (r"\bOF\b\.?", "OFICINA")]
EMAIL = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"
ATTRIBUTE_PHONES = ["Teléfono", "Telefono", "Phone", "Sales", "Llámanos"]
CONTACT_WORDS = ["contacto", "contact", "contactanos", "atencion"]
NULL_DATES = ["99991231", "0", "00000000", ""]

_LETTERS = {chr(i): d[0] for i in range(0xC0, 0x250) if (d := unicodedata.normalize("NFKD", chr(i))) != chr(i) and unicodedata.combining(d[1:2] or "\0")}
_FROM, _TO = "".join(_LETTERS), "".join(_LETTERS.values())


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _FROM, _TO), "[\\u0300-\\u036f]", "")


def _squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _nonblank(c: Column, value: Column) -> Column:
    return F.when(F.trim(c) != "", value)


def normalize_name(c: Column) -> Column:
    """Lower case, no accents, no legal forms, single spaces; null if nothing is left."""
    n = strip_accents(F.lower(F.trim(c)))
    for form in (r"\bs\.a\.s\.?\b", r"\bs\.a\.?\b", r"\be\.u\.?\b"):
        n = F.regexp_replace(n, form, " ")
    n = F.regexp_replace(n, r"[.,;:\-*()]+", " ")
    words = F.filter(F.split(n, r"\s+"), lambda w: (w != "") & ~w.isin(LEGAL_WORDS))
    return _nonblank(c, F.nullif(F.array_join(words, " "), F.lit("")))


def normalize_name_bulk(name: Column, legal: Column) -> Column:
    """The form that linking uses: may be '' but not null unless both inputs are."""
    n = strip_accents(F.lower(F.coalesce(name, legal, F.lit(""))))
    n = F.regexp_replace(n, r"en liquidacion(\s+judicial)?", "")
    n = F.regexp_replace(n, r"(^|\s)s[\s.]*a[\s.]*s[\s.]*(\s|$)|(^|\s)s[\s.]*a[\s.]*(\s|$)|(^|\s)e[\s.]*u[\s.]*(\s|$)", " ")
    n = F.regexp_replace(n, r"\b(" + "|".join(LEGAL_WORDS_BULK) + r")\b", " ")
    n = _squeezed(F.regexp_replace(n, r'[.,;:\-*()/&"]+', " "))
    return F.when(name.isNotNull() | legal.isNotNull(), n)


def normalize_name_upper(c: Column) -> Column:
    return F.coalesce(_squeezed(F.regexp_replace(strip_accents(F.upper(F.trim(c))), r"[^\w\s]", " ")), F.lit(""))


def normalize_phone(c: Column) -> Column:
    """Digits without the country prefix, at least 7, the last 10 of longer ones."""
    t = F.regexp_replace(F.trim(c), r"[\s\-()]+", "")
    t = F.when(t.startswith("+57"), F.substring(t, 4, 1000)).when(t.startswith("57") & (F.length(t) > 10), F.substring(t, 3, 1000)).otherwise(t)
    t = F.regexp_replace(t, "[^0-9]", "")
    return F.when(F.length(t) >= 7, F.when(F.length(t) > 10, F.right(t, F.lit(10))).otherwise(t))


def normalize_phone_bulk(c: Column) -> Column:
    """Drops 57 wherever it stands, but only the first for the check of 7 digits."""
    all_gone = F.regexp_replace(F.regexp_replace(c, "[+]?57", ""), "[^0-9]", "")
    first_gone = F.regexp_replace(F.regexp_replace(c, "(?s)^(.*?)[+]?57", "$1"), "[^0-9]", "")
    return F.when(F.length(first_gone) >= 7, all_gone)


def phone_e164(c: Column, landlines: bool = False, otherwise: str = "original") -> Column:
    """+57 form of mobile numbers (landlines too if asked); else the digits or the original."""
    d = F.regexp_replace(c, "[^0-9]", "")
    starts = (F.length(d) == 10) if landlines else (F.length(d) == 10) & d.startswith("3")
    rest = c if otherwise == "original" else F.nullif(d, F.lit(""))
    return F.when((F.length(d) == 12) & d.startswith("57"), F.concat(F.lit("+"), d)).when(starts, F.concat(F.lit("+57"), d)).otherwise(rest)


def split_phones(c: Column, landlines: bool = True) -> Column:
    """first, rest: the numbers of a list separated by '/', the rest joined by ' / '."""
    parts = F.filter(F.transform(F.split(c, "/"), lambda x: phone_e164(F.trim(x), landlines, "digits")), lambda x: x.isNotNull() & (x != ""))
    rest = F.array_join(F.slice(parts, 2, 1000), " / ")
    return F.struct(F.try_element_at(parts, F.lit(1)).alias("first"), F.nullif(rest, F.lit("")).alias("rest"))


def classify_phone(c: Column) -> Column:
    ten = F.length(c) == 10
    return F.when(ten & c.startswith("3"), "mobile").when(ten & c.startswith("6"), "landline").otherwise("unknown")


def contact_phone_type(c: Column) -> Column:
    return F.when(c.rlike("^3[0-9]{9}$"), "mobile").when(c.rlike("^6"), "landline").otherwise("unknown")


def derive_whatsapp(phone: Column, url: Column) -> Column:
    """The phone if it is a mobile number, else the number of a wa.me link."""
    t = F.regexp_replace(phone, "[^0-9+]", "")
    local = F.regexp_replace(t, r"^\+?57", "")
    mobile = (F.length(local) == 10) & local.startswith("3")
    linked = F.regexp_extract(url, r"wa\.me/\+?([0-9]+)", 1)
    return F.when(mobile, F.when(t.startswith("+"), t).otherwise(F.concat(F.lit("+57"), local))).when(linked != "", F.concat(F.lit("+"), linked))


def normalize_email(c: Column) -> Column:
    e = F.lower(F.trim(c))
    return F.when(e.rlike(EMAIL), e)


def _folded(c: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, word in rules:
        c = F.regexp_replace(c, pattern, word)
    return c


def normalize_address(c: Column) -> Column:
    return _nonblank(c, _squeezed(_folded(strip_accents(F.lower(F.trim(c))), STREETS)))


def normalize_address_upper(c: Column) -> Column:
    a = F.regexp_replace(strip_accents(F.upper(F.trim(c))), "[#\\-°]", " ")
    return F.coalesce(_squeezed(F.regexp_replace(_folded(a, STREETS_UPPER), r"[^\w\s]", " ")), F.lit(""))


def normalize_address_bulk(c: Column) -> Column:
    return strip_accents(F.lower(F.trim(c)))


def normalize_place(c: Column, style: str = "lower") -> Column:
    """lower: no `.,;:`; upper: words only; slug: `[a-z0-9-]`."""
    if style == "upper":
        return F.coalesce(_squeezed(F.regexp_replace(F.replace(strip_accents(F.upper(F.trim(c))), F.lit("-"), F.lit(" ")), r"[^\w\s]", " ")), F.lit(""))
    if style == "slug":
        s = F.regexp_replace(strip_accents(F.lower(F.trim(c))), r"[\s_]+", "-")
        return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9-]", ""), "-+", "-"), "^-|-$", "")
    return _nonblank(c, F.nullif(_squeezed(F.regexp_replace(strip_accents(F.lower(F.trim(c))), "[.,;:]", "")), F.lit("")))


def slug_to_title(c: Column, names: dict[str, str]) -> Column:
    known = F.create_map(*(F.lit(x) for pair in names.items() for x in pair)) if names else None
    title = F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))
    return F.coalesce(F.try_element_at(known, c), title) if names else title


def chamber_to_city(c: Column) -> Column:
    """The city in a chamber's name: before ' para ', else after ' del ', ' de la ' or ' de los ', else all of it."""
    low = F.lower(c)
    after = lambda word: F.substring_index(low, word, -1)
    city = F.when(low.contains(" para "), F.substring_index(low, " para ", 1))
    for word in (" del ", " de la ", " de los "):
        city = city.when(low.contains(word), after(word))
    return strip_accents(F.trim(city.otherwise(low)))


def parse_yyyymmdd(c: Column) -> Column:
    iso = F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return F.when(c.isin(NULL_DATES), None).when(c.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(c, F.lit("yyyyMMdd")))).when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), iso)


def html_to_text(c: Column) -> Column:
    t = F.regexp_replace(c, r"(?i)<br\s*/?>", "\n")
    for name, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(F.regexp_replace(t, "<[^>]+>", " "), "[ \\t]+", " ")
    return F.regexp_replace(F.regexp_replace(t, "\\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def domain_of(c: Column) -> Column:
    return F.replace(F.lower(F.regexp_extract(c, "://([^/?#]*)", 1)), F.lit("www."), F.lit(""))


def canonical_url(c: Column) -> Column:
    return F.substring_index(c, "?", 1)


def listing_hash(*parts: Column, sep: str = "||", sha: bool = False) -> Column:
    """md5 (or sha256) of the trimmed lower-cased parts."""
    joined = F.concat_ws(sep, *(F.lower(F.trim(F.coalesce(p, F.lit("")))) for p in parts))
    return F.sha2(joined, 256) if sha else F.md5(joined)


def to_coordinate(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def match_keys(nit: Column, email: Column, phone: Column, name: Column, place: Column) -> dict[str, Column]:
    return {"key_nit": F.regexp_replace(nit, "[^0-9]", ""), "key_email": email, "key_phone": phone,
            "key_name_place": F.concat(F.coalesce(name, F.lit("")), F.lit("|"), F.coalesce(place, F.lit("")))}


def _all(c: Column, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))))


def extract_emails(c: Column) -> Column:
    return _all(F.lower(c), r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}")


def extract_phones(c: Column) -> Column:
    return F.filter(_all(c, r"\+?[0-9][0-9 ()\-]{5,16}[0-9]"), lambda p: F.length(F.regexp_replace(p, "[^0-9]", "")).between(7, 13))


def extract_whatsapp(c: Column) -> Column:
    return _all(c, r"https?://(?:wa\.me|api\.whatsapp\.com)/[^\s\"'<>]+")


def first_and_rest(c: Column) -> Column:
    return F.struct(F.try_element_at(c, F.lit(1)).alias("first"), F.nullif(F.array_join(F.slice(c, 2, 1000), " | "), F.lit("")).alias("rest"))


def facts_of(text: Column) -> Column:
    """nit, phone and email from joined search snippets."""
    phone = F.regexp_extract(text, r"(?:\+?57[ -]?)?(3[0-9]{2}[ -]?[0-9]{3}[ -]?[0-9]{4})", 1)
    return F.struct(F.nullif(F.regexp_extract(text, r"(?i)\bNIT\s*:?\s*([0-9]{8,10})", 1), F.lit("")).alias("nit"),
                    F.nullif(F.regexp_replace(phone, "[^0-9]", ""), F.lit("")).alias("phone"),
                    F.nullif(F.regexp_extract(F.lower(text), r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}", 0), F.lit("")).alias("email"))


def coordinates_from_url(c: Column) -> Column:
    """lat, lon of a map link: !3d..!4d.. or @lat,lon, else 0.0."""
    def one(marked: str, plain: int) -> Column:
        found = F.coalesce(F.nullif(F.regexp_extract(c, marked, 1), F.lit("")), F.nullif(F.regexp_extract(c, r"@(-?[0-9.]+),(-?[0-9.]+)", plain), F.lit("")))
        return to_coordinate(found)

    return F.struct(one(r"!3d(-?[0-9.]+)", 1).alias("lat"), one(r"!4d(-?[0-9.]+)", 2).alias("lon"))


def label_value(c: Column) -> Column:
    return F.trim(F.substring_index(c, ":", -1))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words, each padded by two blanks in front and one behind."""
    words = F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared over all elements, in single precision as the reference database compares it; 0 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, (both / union).cast("float").cast("double")).otherwise(F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    return set_similarity(trigrams(a), trigrams(b))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres, by the arc cosine."""
    cos = F.sin(F.radians(lat1)) * F.sin(F.radians(lat2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(F.radians(lon1 - lon2))
    return F.when(cos.isNotNull(), F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))) * 6371000)  # least() passes over nulls


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.when(a.isNotNull(), 2 * 6371 * F.asin(F.sqrt(F.least(F.lit(1.0), a))))

"""Personal data in texts: exact base spans, and further spans by labelers that vote, expectation-maximisation over their
votes and a span classifier trained on what that finds. DataFrame functions only; texts never leave their rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.storage import materialize

KINDS = ("email", "ip", "card", "phone")
#: Possessive loops and the looks behind keep the patterns linear on any text; they change no match. \G lets a match
#: begin where the last one ended.
BASE = {"email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "card": r"[0-9](?:[\x20-]?[0-9])++",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_NEEDS = {"email": "contains(text, '@')", "ip": r"text rlike r'[0-9]\.[0-9]'", "card": "text rlike '[0-9][0-9 -]{14}'", "phone": "contains(text, '+')"}

_AT = r"(?: ?[\[({<] ?(?:[aA][tT]|@) ?[\])}>] ?| (?:at|AT) | ?[@＠] ?)"
_DOT = r"(?: ?[\[({<] ?(?:[dD][oO][tT]|\.) ?[\])}>] ?| (?:dot|DOT) |\.)"
_MARKED_DOT = r"(?: ?[\[({<] ?(?:[dD][oO][tT]|\.) ?[\])}>] ?| (?:dot|DOT) )"
#: Wider shapes that may be personal data: spelled or bracketed signs, IPv6, groups of 7 to 19 digits.
LOOSE = "|".join((
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}+",
    rf"(?<![0-9.])[0-9]{{1,3}}(?:{_MARKED_DOT}[0-9]{{1,3}}){{3}}(?![0-9])",
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])",
    r"(?<![0-9A-Za-z])[(+]?[0-9](?:[ ./() -]{0,2}+[0-9]){6,18}+(?![0-9A-Za-z])"))
_LOOSE_NEEDS = r"""piece rlike r'[0-9][ ./() -]{0,2}[0-9]|[@＠:]|[\[({<] ?[aA][tT]| (?:at|AT) '"""

#: Top-level domains, beginnings of card numbers, calling codes, and words that stand near.
DOMAINS = ("com org net edu gov mil int info biz name io co ai app dev me tv eu uk us ca au nz ie de fr es it nl be ch at se no dk fi pl pt cz sk hu ro bg gr tr ru ua cn jp kr in sg hk tw br mx ar cl pe ve za ng ke eg il ae").split()
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[68])|35|6011|64[4-9]|65|62)"
CALLING = r"^(?:\+|00)[ (]{0,2}(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2356789][0-9]{2})"
NEAR = {"email": r"e-?mail|mail|contact|write|correo|kontakt|courriel|adresse",
        "ip": r"\bip\b|ipv[46]|address|host|server|client|login|adresse",
        "card": r"card|visa|master|amex|credit|debit|payment|carte|karte|tarjeta|kredit",
        "phone": r"phone|\btel\b|tel\.|telef|téléph|call|mobile|\bcell|fax|whatsapp|handy|móvil|\bring\b"}
FAR = r"version|\bv\.?\s*$|isbn|issn|order|invoice|section|figure|\bid\b|sku|serial|token|hash|page|chapter|\bno\.|doi|price|total|date|release|build"

LABELERS = 5
FEATURES = ("strict", "shaped", "unshaped", "check_yes", "check_no", "listed", "unlisted", "near", "far", "glued", "labelled", "solid", "spelled", "led")


def _let(value: str, name: str, body: str) -> str:
    """body with name standing for value, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(lengths: str) -> str:
    """For every element of an integer array the sum of those before it, in blocks of about the root of its size."""
    total = lambda x: f"aggregate({x}, 0, (s, e) -> s + e)"
    last = f"transform(v, (x, i) -> o[int(i div w)] + {total('slice(v, int(i div w) * w + 1, i % w)')})"
    before = _let(f"transform(k, (x, b) -> {total('slice(k, 1, b)')})", "o", last)
    blocks = _let(f"transform(sequence(0, int((size(v) - 1) div w)), b -> {total('slice(v, b * w + 1, w)')})", "k", before)
    return _let(lengths, "v", f"if(size(v) = 0, v, {_let('int(ceil(sqrt(size(v))))', 'w', blocks)})")


def _hits(pieces: str, hits: str) -> str:
    """Structs (start, end, hit, before, after) of the matches between pieces, in code points; before and after are at
    most 40 and 20 characters of context."""
    step = f"transform({hits}, (h, i) -> length(h) + length({pieces}[i]))"
    one = (f"named_struct('start', r[i] + length({pieces}[i]), 'end', r[i] + length({pieces}[i]) + length(h), 'hit', h, "
           f"'before', right({pieces}[i], 40), 'after', left({pieces}[i + 1], 20))")
    return _let(_running(step), "r", f"transform({hits}, (h, i) -> {one})")


_DIGITS = "regexp_replace(c.hit, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    value = f"int(substr({digits}, length({digits}) - i, 1))"
    return f"(aggregate(sequence(0, length({digits}) - 1), 0, (s, i) -> s + if(i % 2 = 0, {value}, 2 * {value} - if({value} > 4, 9, 0))) % 10 = 0)"


_VALID = {"email": "true",
          "ip": "forall(split(c.hit, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 3 and int(concat('0', right(regexp_replace(p, '^0+', ''), 3))) <= 255)",
          "card": f"length({_DIGITS}) between 16 and 19 and {_luhn(_DIGITS)}",
          "phone": f"length({_DIGITS}) between 8 and 15"}


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds to a frame with text one array for each kind: structs (start, end, hit, before, after) of its base spans,
    and `failed`: the card and address shapes that failed their test."""
    for kind in KINDS:
        pattern = BASE[kind]
        some = F.coalesce(F.expr(_NEEDS[kind]), F.lit(False))
        docs = docs.withColumn("__p", F.when(some, F.split("text", pattern, -1))).withColumn("__h", F.when(some, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
        docs = docs.withColumn("__m", F.expr(f"if(size(__h) > 0, {_hits('__p', '__h')}, null)"))
        docs = docs.withColumn(kind, F.expr(f"filter(coalesce(__m, array()), c -> {_VALID[kind]})"))
        if kind in ("card", "ip"):
            shape = f"length({_DIGITS}) between 13 and 19" if kind == "card" else "true"
            docs = docs.withColumn(f"failed_{kind}", F.expr(f"filter(coalesce(__m, array()), c -> {shape} and not ({_VALID[kind]}))"))
        docs = docs.drop("__p", "__h", "__m")
    return docs


def _loose_spans(docs: DataFrame) -> DataFrame:
    """Adds loose: matches of the wider shapes in what lies between the base shapes, so neither overlaps the other."""
    shapes = "|".join(f"(?:{BASE[k]})" for k in ("email", "ip", "phone")) + r"|(?:(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}+(?![0-9]))"
    some = F.coalesce(F.expr(_LOOSE_NEEDS.replace("piece", "text")), F.lit(False))
    docs = docs.withColumn("__p", F.when(some, F.split("text", shapes, -1))).withColumn("__h", F.when(some, F.regexp_extract_all("text", F.lit(shapes), F.lit(0))))
    # worked out by _let: a column that is named once would be moved into the lambda and worked out for every piece
    offsets = _running("transform(__p, (p, i) -> length(p) + length(coalesce(get(__h, i), '')))")
    some_pieces = f"filter(transform(__p, (piece, i) -> named_struct('o', o[i], 'piece', if({_LOOSE_NEEDS}, piece, ''))), x -> x.piece != '')"
    docs = docs.withColumn("__f", F.expr(f"if(size(__p) > 0, {_let(offsets, 'o', some_pieces)}, null)"))
    docs = docs.withColumn("__s", F.transform("__f", lambda x: F.struct(x["o"].alias("o"), F.split(x["piece"], LOOSE, -1).alias("p"), F.regexp_extract_all(x["piece"], F.lit(LOOSE), F.lit(0)).alias("h"))))
    inner = f"transform({_hits('x.p', 'x.h')}, c -> named_struct('start', c.start + x.o, 'end', c.end + x.o, 'hit', c.hit, 'before', c.before, 'after', c.after))"
    return docs.withColumn("loose", F.expr(f"coalesce(flatten(transform(filter(__s, x -> size(x.h) > 0), x -> {inner})), array())")).drop("__p", "__h", "__f", "__s")


_LOOSE_KIND = f"""case when c.hit rlike r'[A-Za-z@＠]' and not c.hit rlike r'^[0-9A-Fa-f:]+$' then if(c.hit rlike r'^[0-9]' and not c.hit rlike r'{_AT}[A-Za-z]', 'ip', 'email')
    when c.hit rlike r'^[0-9A-Fa-f:]+:[0-9A-Fa-f:]+$' or c.hit rlike r'[\\[({{<] ?[.]' then 'ip' when length({_DIGITS}) >= 13 then 'card' else 'phone' end"""


def candidate_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the base arrays and candidates: an array of structs (kind, start, end, votes, features, same). Every base
    span is a candidate with strict set; votes holds one digit a labeler (0 against, 1 none, 2 for) in base three and
    before them a 1 for base spans; features one bit for each of FEATURES; same is a hash of the
    span's text."""
    d = _loose_spans(base_spans(docs))
    named = lambda column, kind, strict: f"transform({column}, c -> named_struct('kind', {kind}, 'strict', {strict}, 'start', c.start, 'end', c.end, 'hit', c.hit, 'before', lower(c.before), 'after', c.after))"
    failed_ip = f"if(length({_DIGITS}) between 13 and 19, 'card', 'ip')"
    parts = [named(k, f"'{k}'", "true") for k in KINDS] + [named("failed_card", "'card'", "false"), named("failed_ip", failed_ip, "false")] + [named("loose", _LOOSE_KIND, "false")]
    d = d.withColumn("__c", F.expr(f"concat({', '.join(parts)})"))

    digits, by = _DIGITS, lambda **k: "case c.kind " + " ".join(f"when '{n}' then {e}" for n, e in k.items()) + " end"
    tld = f"lower(regexp_extract(c.hit, r'([A-Za-z]+)$', 1))"
    shaped = by(email=r"case when c.strict or c.hit rlike r'[\[({<] ?(?:[aA][tT]|@)|[＠]' then 2 when c.hit rlike r' (?:at|AT) ' and not c.hit rlike r' (?:dot|DOT) ' then 0 else 1 end",
                ip="if(c.strict or c.hit rlike r'[\\[({<]|::' or c.hit rlike r'^(?:[0-9A-Fa-f]{1,4}:){7}', 2, 0)",
                card=r"if(c.hit rlike r'^(?:[0-9]{13,19}|[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ .-])[0-9]{6}\2[0-9]{5})$', 2, 0)",
                phone=r"case when c.strict or c.hit rlike r'^(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$' or c.hit rlike r'^00[1-9][0-9 ().-]+$' then 2 when c.hit rlike r'^(?:[12][0-9]{3}|[0-9]{1,2})[-/.][01]?[0-9][-/.]' or not c.hit rlike r'^[+(]?[0-9]{1,5}(?:[ ./()-]{1,2}[0-9]{2,5}){2,5}$' then 0 else 1 end")
    check = by(email=f"if(length({tld}) between 2 and 6 and not (c.hit rlike r' (?:at|AT) ' and not c.hit rlike r' (?:dot|DOT) '), 2, 0)", ip="if(c.hit rlike r'[:]' or (c.strict or forall(regexp_extract_all(c.hit, '[0-9]+', 0), p -> int(right(p, 9)) <= 255)), 2, 0)",
               card=f"if(length({digits}) between 13 and 19 and {_luhn(digits)}, 2, 0)", phone=f"if(length({digits}) between if(c.strict, 8, 10) and 15 and not {digits} rlike r'^(.)\\1+$', 2, 0)")
    listed = by(email=f"if({tld} in ({', '.join(repr(x) for x in DOMAINS)}), 2, 0)", ip=r"if(c.hit rlike r'^(?:0|127|255)[.]|^(?:0{1,4}:)+', 0, 1)",
                card=f"if({digits} rlike r'{ISSUERS}', 2, 0)", phone=f"if(c.hit rlike r'{CALLING}', 2, 1)")
    near = "(" + by(**{k: f"concat(c.before, ' ', lower(c.after)) rlike r'{v}'" for k, v in NEAR.items()}) + ")"
    context = f"if({near}, 2, if(c.before rlike r'{FAR}', 0, 1))"
    glued = r"""if(c.before rlike r'[\p{L}\p{N}_"\x27#=]$' or c.after rlike r'^[\p{L}\p{N}_"\x27]', 0, 1)"""
    votes = [shaped, check, listed, context, glued]
    d = d.withColumn("__v", F.expr(f"transform(__c, c -> named_struct('c', c, 'v', array({', '.join(votes)})))"))
    bits = ["x.c.strict", "x.v[0] = 2", "x.v[0] = 0", "x.v[1] = 2", "x.v[1] = 0", "x.v[2] = 2", "x.v[2] = 0", "x.v[3] = 2", "x.v[3] = 0", "x.v[4] = 0", r"x.c.before rlike r'[:=]\s?$'",
            "x.c.hit rlike '^[0-9]+$'", r"x.c.hit rlike r'[\[({<] ?(?:[a-zA-Z.@]+) ?[\])}>]| (?:at|AT|dot|DOT) |＠'", r"x.c.hit rlike r'^(?:[+(]|00)'"]
    features = " + ".join(f"if({b}, {1 << i}, 0)" for i, b in enumerate(bits))
    code = " + ".join(f"{3 ** i} * x.v[{i}]" for i in range(LABELERS)) + f" + if(x.c.strict, {3 ** LABELERS}, 0)"
    d = d.withColumn("candidates", F.expr(f"transform(__v, x -> named_struct('kind', x.c.kind, 'start', x.c.start, 'end', x.c.end, 'votes', {code}, 'features', {features}, 'same', xxhash64(x.c.hit)))"))
    plain = [F.transform(k, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))).alias(k) for k in KINDS]
    return d.select("doc_id", *plain, "candidates")


class VoteModel:
    """Reliabilities of labelers by expectation-maximisation over counts of vote patterns (Dawid and Skene).

    A pattern is (kind, votes); its hidden class is personal or not. prior holds the share of personal spans by kind,
    of base spans and of others; yes and no hold for every labeler the probabilities of its three votes. Base spans are
    known to be personal, only the others' class is estimated. Pseudo-counts keep labelers that hardly
    speak near their start, better than chance, so the two classes can't trade places.
    """

    START = ((0.1, 0.3, 0.6), (0.6, 0.3, 0.1))

    def __init__(self, counts: dict[tuple[str, int], int], rounds: int = 50, weight: float = 20.0):
        self.no = [list(self.START[1]) for _ in range(LABELERS)]
        self.yes = [list(self.START[0]) for _ in range(LABELERS)]
        self.prior = {(k, strict): 0.5 for k in KINDS for strict in (0, 1)}
        for _ in range(rounds):
            mass = {k: [1.0, 1.0] for k in self.prior}
            seen = [[[weight * p for p in start] for _ in range(LABELERS)] for start in reversed(self.START)]
            for (kind, votes), n in counts.items():
                p = 1.0 if votes // 3 ** LABELERS else self.posterior(kind, votes)  # base spans are personal
                for c, share in ((0, 1 - p), (1, p)):
                    mass[kind, votes // 3 ** LABELERS][c] += n * share
                    for i in range(LABELERS):
                        seen[c][i][votes // 3 ** i % 3] += n * share
            self.prior = {k: m[1] / sum(m) for k, m in mass.items()}
            self.no, self.yes = ([[v / sum(row) for v in row] for row in part] for part in seen)

    def posterior(self, kind: str, votes: int) -> float:
        prior = self.prior[kind, votes // 3 ** LABELERS]
        odds = math.log(prior / (1 - prior))
        for i in range(LABELERS):
            v = votes // 3 ** i % 3
            odds += math.log(self.yes[i][v] / self.no[i][v])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


class SpanClassifier:
    """Logistic regression over feature bits and kinds, by gradient steps on soft labels; rows are distinct (kind,
    features) with the number of their spans and the sum of their posteriors. `strict` is no feature of it: what base
    spans look like has to carry over to others."""

    def __init__(self, rows: list[tuple[str, int, int, float]], rounds: int = 300, ridge: float = 1.0):
        width = len(FEATURES) + len(KINDS)
        self.w = [0.0] * width
        at = [([i for i in range(1, len(FEATURES)) if f >> i & 1] + [len(FEATURES) + KINDS.index(k)], n, p) for k, f, n, p in rows]
        # steps by an upper bound of the curvature along each weight: they cannot overshoot
        most = [ridge] * width
        for on, n, _ in at:
            for i in on:
                most[i] += n * len(on) / 4
        for _ in range(rounds):
            slope = [-ridge * w for w in self.w]
            for on, n, p in at:
                miss = p - n * self._sigmoid(sum(self.w[i] for i in on))
                for i in on:
                    slope[i] += miss
            self.w = [w + s / m for w, s, m in zip(self.w, slope, most)]

    @staticmethod
    def _sigmoid(z: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

    def score(self, kind: str, features: int) -> float:
        return self._sigmoid(sum(self.w[i] for i in range(len(FEATURES)) if features >> i & 1) + self.w[len(FEATURES) + KINDS.index(kind)])

    def expression(self, c: str) -> str:
        """The same score of a candidate struct, as SQL."""
        parts = [f"if({c}.features & {1 << i} != 0, {w!r}D, 0D)" for i, w in enumerate(self.w[:len(FEATURES)])]
        kinds = " ".join(f"when '{k}' then {w!r}D" for k, w in zip(KINDS, self.w[len(FEATURES):]))
        return f"1 / (1 + exp(-({' + '.join(parts)} + case {c}.kind {kinds} end)))"


def fit_spans(found: DataFrame) -> tuple[VoteModel, SpanClassifier]:
    """Both models from candidates of all documents, where a span's text counts once for each way it stands there, so
    that copies have no say. Only counts come to the driver: by kind and votes, at most
    8 * 3^5, and by kind and features, at most 4 * 2^14, however many documents there are."""
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features", "c.same")
    each = materialize(each.groupBy("kind", "votes", "features").agg(F.count_distinct("same").alias("n")))
    votes = VoteModel({(r.kind, r.votes): r.n for r in each.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()})
    known = F.create_map(*(F.lit(x) for k in KINDS for v in range(2 * 3 ** LABELERS) for x in (f"{k}{v}", votes.posterior(k, v))))
    soft = each.withColumn("p", F.col("n") * known[F.concat("kind", F.col("votes").cast("string"))])
    rows = soft.groupBy("kind", "features").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).orderBy("kind", "features").collect()
    return votes, SpanClassifier([(r.kind, r.features, r.n, r.p) for r in rows])


def _joined(column: str) -> str:
    return f"array_join(transform({column}, c -> concat_ws(':', c.kind, string(c.start), string(c.end))), ',')"


def personal_spans(docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base, spans for every row: base is the array of base spans (kind, start,
    end; code points, end exclusive) in order of kind and start, spans the same with what the classifier adds.

    Labelers by pattern, check, list, context and boundary vote on each candidate; expectation-maximisation over the
    counts of vote patterns tells how far each can be trusted, and a logistic classifier over the candidates' features,
    fitted on its posteriors over all documents, decides with `threshold`. Base spans always stay; candidates come from
    between them. Null and empty texts have no spans; repeated rows have a result each; null ids stay; texts of any
    length stay in their row, in time linear but for the root of the number of their spans.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = materialize(candidate_spans(d))
    _, classifier = fit_spans(found)
    listed = ", ".join(f"transform({k}, c -> named_struct('kind', '{k}', 'start', c.start, 'end', c.end))" for k in KINDS)
    d = found.withColumn("base", F.expr(f"concat({listed})"))
    more = f"transform(filter(candidates, c -> c.features & 1 = 0 and {classifier.expression('c')} >= {threshold}), c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end))"
    number = "case x.kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS)) + " end"
    order = f"transform(concat(base, {more}), x -> named_struct('k', {number}, 'start', x.start, 'end', x.end, 'kind', x.kind))"
    d = d.withColumn("spans", F.expr(f"transform(array_sort({order}), x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end))"))
    return d.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), "base", "spans")


def span_digests(found: DataFrame) -> DataFrame:
    """The result of personal_spans() with base as a SHA-256 and spans as a string of kind:start:end."""
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"), F.expr(_joined("spans")).alias("spans"))

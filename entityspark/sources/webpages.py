"""Contacts, descriptions and links from stored web pages."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityspark.functions import text as X


class _Head(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.metas: list[dict] = []
        self.links: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.metas.append(a)
        elif tag == "a" and a.get("href"):
            self.links.append([a["href"], ""])
            self.open = True

    def handle_endtag(self, tag: str) -> None:
        self.open &= tag != "a"

    def handle_data(self, data: str) -> None:
        if self.open:
            self.links[-1][1] += data


@F.pandas_udf(T.StructType([T.StructField("description", T.StringType()), T.StructField("contact", T.StringType())]))
def page_facts(url: pd.Series, html: pd.Series) -> pd.DataFrame:
    """The description of a page and its contact page, resolved against its address."""
    out = []
    for u, h in zip(url, html):
        p = _Head()
        p.feed(h or "")
        named = {(m.get("name") or m.get("property") or "").lower(): m.get("content", "") for m in reversed(p.metas)}
        link = next((x for x, text in p.links if any(w in f"{x} {text}".lower() for w in X.CONTACT_WORDS)), None)
        out.append((named.get("description") or named.get("og:description") or None, urljoin(u or "", link) if link else None))
    return pd.DataFrame(out, columns=["description", "contact"])


_ATTRIBUTE = r"""[^\s"'=<>/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+))?"""
#: What is no markup of its own: comments, and the insides of these elements.
_UNREAD = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"


def _attributes(tag: Column) -> Column:
    """Names and values of a tag's attributes, in order."""
    value = lambda t: F.regexp_replace(F.regexp_extract(t, r"(?s)=\s*(.*)$", 1), r"""^["']|["']$""", "")
    return F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0)), lambda t: F.struct(F.lower(F.regexp_extract(t, r"^([^\s=]+)", 1)).alias("k"), value(t).alias("v")))


def _value(attributes: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(attributes, lambda x: x["k"] == name), F.lit(-1))["v"], F.lit(""))


def _joined(url: Column, link: Column) -> Column:
    """A link against its page's address, null for forms that need a real resolver."""
    root = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"[^/]*$", "")
    base = F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(?:[?#].*)?$"), F.concat(root, F.lit("/"))).otherwise(path)
    plain = (root != "") & ~link.rlike(r"(?:^|/)\.\.?(?:/|$|\?|#)|\s")
    return F.when(plain & link.rlike(r"^(?:https?://[^/?#]|mailto:|tel:)"), link).when(plain & link.rlike(r"^/[^/]"), F.concat(root, link)).when(plain & link.rlike(r"^[A-Za-z0-9_-][^:]*$"), F.concat(base, link))


def scanned_facts(url: Column, html: Column) -> Column:
    """description and contact as page_facts() finds them, by patterns over the tags, and read: whether the page is of
    the kind that these can read. References in heads or links, markup in titles, quotes that don't close within their
    tag and links that need a resolver are left to the parser."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _UNREAD, "")
    metas = F.transform(F.regexp_extract_all(text, F.lit(r"(?is)<meta\b([^>]*)>"), F.lit(1)), _attributes)
    named = F.transform(metas, lambda m: F.struct(F.lower(F.coalesce(F.nullif(_value(m, "name"), F.lit("")), _value(m, "property"))).alias("k"), _value(m, "content").alias("v")))
    first = lambda name: F.nullif(F.get(F.filter(named, lambda m: m["k"] == name), F.lit(0))["v"], F.lit(""))
    tags = F.regexp_extract_all(text, F.lit(r"(?is)<a\b[^>]*>.*?(?=</a\b|<a\b|\z)"), F.lit(0))
    links = F.transform(tags, lambda t: F.struct(_value(_attributes(F.regexp_extract(t, r"(?is)^<a\b([^>]*)>", 1)), "href").alias("href"), F.regexp_replace(F.regexp_replace(t, r"(?is)^<a\b[^>]*>", ""), r"<[^>]*>", "").alias("text")))
    words = "|".join(X.CONTACT_WORDS)
    link = F.get(F.filter(links, lambda x: (x["href"] != "") & F.lower(F.concat(x["href"], F.lit(" "), x["text"])).rlike(words)), F.lit(0))["href"]
    contact = _joined(F.coalesce(url, F.lit("")), link)
    odd = text.rlike(r"""(?is)<(?:meta|a)\b[^>]*=\s*(?:"[^">]*>|'[^'>]*>)|<(?:meta|a)\b[^>]*(?:&|<|$)|<a\b(?![^>]*\bhref\s*=)|<(title|textarea)\b[^>]*>[^<]*<(?!/\1)""") | F.exists(tags, lambda t: t.contains("&"))
    return F.struct(F.coalesce(first("description"), first("og:description")).alias("description"), contact.alias("contact"), (~odd & (link.isNull() | contact.isNotNull())).alias("read"))


def with_facts(pages: DataFrame) -> DataFrame:
    """pages with a struct f of description and contact: by patterns where they can read the page, and only what is left
    goes to Python and its parser."""
    d = pages.withColumn("f", scanned_facts(F.col("url"), F.col("html")))
    return d.where("f.read").withColumn("f", F.struct("f.description", "f.contact")).unionByName(d.where("not f.read").withColumn("f", page_facts("url", "html")))


def contacts_of(pages: DataFrame) -> DataFrame:
    """page_id, url, description, contact, and the first and other e-mails, phones and WhatsApp links of each page."""
    html = F.col("html")
    cols = {"email": X.extract_emails(html), "phone": X.extract_phones(X.html_to_text(html)), "whatsapp": X.extract_whatsapp(html)}
    d = with_facts(pages.select("page_id", "url", "html")).select("page_id", "url", "f", *(X.first_and_rest(c).alias(n) for n, c in cols.items()))
    return d.select("page_id", "url", "f.description", "f.contact", *(F.col(f"{n}.{p}").alias(n if p == "first" else f"{n}_rest") for n in cols for p in ("first", "rest")))


def propagate_contacts(results: DataFrame, pages: DataFrame) -> DataFrame:
    """Search results with their page's contacts where their own are blank, and is_enriched. pages: contacts_of()."""
    p = pages.select("url", *(F.col(c).alias(f"__{c}") for c in ("email", "phone", "whatsapp", "description"))).dropDuplicates(["url"])
    d = results.where("result_type in ('organic', 'knowledgeGraph') and trim(url) != ''").join(p, "url", "left")
    own = lambda c: F.coalesce(F.when(F.trim(c) != "", F.col(c)), F.col(f"__{c}")) if c in results.columns else F.col(f"__{c}")
    found: Column = F.coalesce("__email", "__phone", "__whatsapp", "__description").isNotNull()
    return d.withColumns({c: own(c) for c in ("email", "phone", "whatsapp")} | {"is_enriched": found}).drop("__email", "__phone", "__whatsapp", "__description")

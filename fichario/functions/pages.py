"""Page functions: links (C5, C6), platforms (G1, W3), chat (G2), commerce flags (G3, G6), title.

Most patterns are plain words, so they run as byte searches over the lower-cased page; only true
patterns use the regex engine. Case folding of accented letters needs the ``(?iU)`` flags.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import urls
from fichario.functions.contacts import normalize_phone
from fichario.functions.text import contains_any, digits, strip

_HREF = r"""(?i)href=["']([^"']+)["']"""

FLAGS = (
    "has_product_page", "has_product_schema", "has_price", "has_cart", "has_checkout",
    "has_add_to_cart", "has_catalog", "has_search", "has_customer_login", "has_contact_form",
    "coming_soon",
)


def _matches(page: Column, lower: Column, pattern: str) -> Column:
    """Search one pattern without case; literal patterns become byte searches."""
    literal = re.sub(r"\\(.)", r"\1", pattern)
    if re.escape(literal).replace("\\", "") == literal and "." not in pattern.replace(r"\.", ""):
        return F.contains(lower, F.lit(literal.lower()))
    return page.rlike("(?iU)" + pattern)


def hrefs(html: Column) -> Column:
    """All link targets of a page in page order."""
    return F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))


def _whatsapp_number(href: Column) -> Column:
    """Number part of one WhatsApp link, as written; NULL when the link carries none."""
    short_link = F.contains(F.lower(urls.authority(href)), F.lit("wa.me"))
    from_path = F.nullif(digits(F.regexp_extract(urls.path(href), "^([^;]*)", 1)), F.lit(""))
    return F.when(short_link, from_path).otherwise(urls.query_value(href, "phone", "Phone"))


def whatsapp_link(html: Column, base_url: Column) -> Column:
    """First valid WhatsApp link, else the first detected one.

    STRUCT(detected, number, normalized, valid, canonical_url, confidence).
    """
    absolute = F.transform(hrefs(html), lambda h: urls.resolve_href(h, base_url))
    found = F.filter(absolute, lambda h: contains_any(F.lower(h), K.WHATSAPP_TOKENS))
    links = F.transform(
        F.transform(found, _whatsapp_number),
        lambda n: F.struct(n.alias("number"), normalize_phone(n).alias("normalized")),
    )
    valid = F.filter(links, lambda link: link["normalized"].isNotNull())
    best = F.get(valid, F.lit(0))
    detected = F.coalesce(F.size(links) > 0, F.lit(False))
    is_valid = best.isNotNull()
    return F.struct(
        detected.alias("detected"),
        best["number"].alias("number"),
        best["normalized"].alias("normalized"),
        is_valid.alias("valid"),
        F.concat(F.lit("https://wa.me/"), best["normalized"]).alias("canonical_url"),
        F.when(is_valid, 90).when(detected, 10).otherwise(0).alias("confidence"),
    )


def social_link(html: Column, base_url: Column, host: str) -> Column:
    """First link to ``host``, query string cut; NULL when there is none."""
    absolute = F.transform(hrefs(html), lambda h: urls.resolve_href(h, base_url))
    found = F.filter(absolute, lambda h: F.contains(F.lower(h), F.lit(host + "/")))
    return F.substring_index(F.get(found, F.lit(0)), "?", 1)


def platforms(html: Column, lower: Column) -> Column:
    """G1 + W3: ARRAY of STRUCT(name, confidence), best first, list order on ties."""
    scored = []
    for position, (name, patterns) in enumerate(K.PLATFORM_PATTERNS.items()):
        hits = reduce(
            lambda a, b: a + b, [_matches(html, lower, p).cast("int") for p in patterns]
        )
        confidence = F.when(hits >= 3, 95).when(hits == 2, 75).when(hits == 1, 45).otherwise(0)
        scored.append(
            F.struct(
                (-confidence).alias("rank"), F.lit(position).alias("position"),
                F.lit(name).alias("name"),
            )
        )
    found = F.array_sort(F.filter(F.array(*scored), lambda s: s["rank"] < 0))
    return F.transform(
        found,
        lambda s: F.struct(s["name"].alias("name"), (-s["rank"]).alias("confidence")),
    )


def chat_provider(html: Column, lower: Column) -> Column:
    """First chat provider in list order, ``custom`` for a generic widget, else NULL."""
    rule = None
    for name, patterns in K.CHAT_PATTERNS.items():
        hit = reduce(lambda a, b: a | b, [_matches(html, lower, p) for p in patterns])
        rule = F.when(hit, name) if rule is None else rule.when(hit, name)
    return rule.when(contains_any(lower, K.GENERIC_CHAT_WORDS), "custom")


def commerce_flags(html: Column, lower: Column) -> dict[str, Column]:
    """The ten commerce flags and the not-yet-open flag."""
    product_schema = (
        html.rlike(r'(?iU)"@type"\s*:\s*"Product"')
        | html.rlike(r"(?iU)application/ld\+json[^>]*>[^<]*Product")
        | html.rlike(r'(?iU)property="og:type"\s+content="product"')
    )
    # A price word anywhere after the first product class. Atomic groups keep this linear: a page
    # with many product classes and no price is read once, not once per class.
    priced_product = html.rlike(
        r'(?isU)\A(?>.*?class="[^"]*product[^"]*")(?>.*?(?:R\$|\bprice\b|\bpreço\b))'
    )
    written_price = html.rlike(r"(?U)R\$\s?\d{1,3}(?:\.\d{3})*,\d{2}")
    return {
        "has_product_page": lower.rlike(K.PRODUCT_PAGE_PATTERN),
        "has_product_schema": product_schema,
        "has_price": priced_product | written_price,
        "has_cart": contains_any(lower, K.CART_WORDS),
        "has_checkout": contains_any(lower, K.CHECKOUT_WORDS),
        "has_add_to_cart": contains_any(lower, K.ADD_TO_CART_WORDS),
        "has_catalog": contains_any(lower, K.CATALOG_WORDS),
        "has_search": contains_any(lower, K.SEARCH_WORDS),
        "has_customer_login": contains_any(lower, K.LOGIN_WORDS),
        "has_contact_form": lower.rlike(K.CONTACT_FORM_PATTERN),
        "coming_soon": contains_any(lower, K.COMING_SOON_WORDS),
    }


def strong_commerce(c) -> Column:
    """G6 over a getter of the commerce columns: ``c('has_checkout')`` and so on."""

    def flag(name: str) -> Column:
        return F.coalesce(c(name), F.lit(False))

    return (
        flag("has_checkout")
        | (flag("has_cart") & flag("has_add_to_cart"))
        | (
            flag("has_product_schema")
            & flag("has_price")
            & (F.coalesce(c("plataforma"), F.lit("")) != "")
        )
    )


def title(html: Column) -> Column:
    """Text of the first title element of 1 to 200 characters, stripped; empty when missing."""
    return strip(F.regexp_extract(html, r"(?i)<title[^>]*>([^<]{1,200})</title>", 1))

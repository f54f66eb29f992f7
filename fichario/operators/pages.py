"""Page jobs: signals per page (G1-G3, G7, C5, C6), site roll-up (G4, A7), fetch outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import pages as P
from fichario.functions import urls
from fichario.functions.text import digits, normalize_text

_PLATFORM_NAMES = tuple(K.PLATFORM_PATTERNS)
_CHAT_NAMES = (*K.CHAT_PATTERNS, "custom")


def page_signals(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """All signals of each page; one projection, no shuffle. The page text itself is dropped."""
    page, base = F.col(html), F.col(url)
    lowered = pages.withColumn("_lower", F.lower(page))
    lower = F.col("_lower")
    found = lowered.withColumns(
        {
            **P.commerce_flags(page, lower),
            "_platforms": P.platforms(page, lower),
            "chat_provider": P.chat_provider(page, lower),
            "site_titulo": P.title(page),
            "whatsapp": P.whatsapp_link(page, base),
            "instagram_url": P.social_link(page, base, "instagram.com"),
            "linkedin_url": P.social_link(page, base, "linkedin.com"),
            "host": urls.site_host(base),
        }
    )
    best = F.get("_platforms", F.lit(0))
    return found.withColumns(
        {
            "plataforma": best["name"],
            "plataforma_confianca": F.coalesce(best["confidence"], F.lit(0)),
            "plataformas_detectadas": F.transform("_platforms", lambda p: p["name"]),
            "has_chat": F.col("chat_provider").isNotNull(),
        }
    ).drop("_lower", "_platforms", html)


def visit_order(url: Column) -> Column:
    """Place of a URL among the pages of its site: landing page 0, inner paths 1 to 13 with or without
    a final slash, all other paths after them."""
    path = F.regexp_replace(urls.path(url), "/+$", "")
    order = F.when(path == "", 0)
    for position, inner in enumerate(K.INNER_PATHS, start=1):
        order = order.when(path == inner.rstrip("/"), position)
    return order.otherwise(len(K.INNER_PATHS) + 1)


def merge_signals(signals: DataFrame, group: str, order: str) -> DataFrame:
    """Flags by OR, first chat and platform in visit order, best confidence, platform list.

    Chats and platforms come from fixed lists, so "first in visit order" is the minimum of one
    number (visit place, list place). Every buffer is a fixed-size number: a plain hash aggregate
    that shrinks a site to one row per task, however many pages the site has.
    """

    def first_of(names: tuple[str, ...], column: str) -> Column:
        place = F.array_position(F.array(*map(F.lit, names)), F.col(column))
        return F.min(F.when(F.col(column).isNotNull(), F.col(order) * 100 + place))

    def name_at(names: tuple[str, ...], code: str) -> Column:
        return F.get(F.array(*map(F.lit, names)), (F.col(code) % 100 - 1).cast("int"))

    def first_seen(name: str) -> Column:
        listed = F.array_position("plataformas_detectadas", name)
        return F.min(F.when(listed > 0, F.col(order) * 100 + listed))

    merged = signals.groupBy(group).agg(
        *[F.bool_or(flag).alias(flag) for flag in (*P.FLAGS, "has_chat")],
        F.max("plataforma_confianca").alias("plataforma_confianca"),
        first_of(_CHAT_NAMES, "chat_provider").alias("_chat"),
        first_of(_PLATFORM_NAMES, "plataforma").alias("_platform"),
        *[first_seen(name).alias(f"_seen_{name}") for name in _PLATFORM_NAMES],
    )
    seen = F.array(
        *[F.struct(F.col(f"_seen_{n}").alias("at"), F.lit(n).alias("name")) for n in _PLATFORM_NAMES]
    )
    in_order = F.array_sort(F.filter(seen, lambda s: s["at"].isNotNull()))
    return merged.withColumns(
        {
            "chat_provider": name_at(_CHAT_NAMES, "_chat"),
            "plataforma": name_at(_PLATFORM_NAMES, "_platform"),
            "plataformas_detectadas": F.transform(in_order, lambda s: s["name"]),
        }
    ).drop("_chat", "_platform", *[f"_seen_{n}" for n in _PLATFORM_NAMES])


def site_rollup(signals: DataFrame) -> DataFrame:
    """Signals of all pages of each site, merged by A7."""
    return merge_signals(
        signals.withColumn("visit_order", visit_order(F.col("url"))), "host", "visit_order"
    )


def is_html(content_type: Column) -> Column:
    media = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return F.contains(media, F.lit("text/html")) | F.contains(media, F.lit("application/xhtml"))


def fetch_outcome(log: DataFrame, failed_retry_hours: int = K.FAILED_RETRY_HOURS) -> DataFrame:
    """Reachability, error label and retry delay of each logged fetch.

    ``error`` of the log holds what failed before any HTTP status: a DNS failure, an unsafe
    address, a redirect problem or the class of a connection error.
    """
    status, error = F.col("status"), F.col("error")
    unanswered = status.isNull() | status.between(300, 399)
    dns = unanswered & (error == "dns_falhou")
    refused = unanswered & (
        error.isin(
            "scheme_invalido", "credenciais_na_url", "host_ausente", "localhost",
            "redirect_sem_location", "max_redirects",
        )
        | error.startswith("ip_bloqueado")
        | error.startswith("redirect_bloqueado")
    )
    success = status.between(200, 299)
    html_page = success & is_html(F.col("content_type"))
    other_type = success & ~is_html(F.col("content_type"))
    wait = F.when(
        F.col("retry_after").rlike("^[0-9]+$"), F.col("retry_after").try_cast("int")
    )
    label = (
        F.when(unanswered, error)
        .when(status == 429, "rate_limited")
        .when(other_type, "conteudo_nao_html")
        .when(~success, F.concat(F.lit("http_"), status.cast("string")))
    )
    return log.withColumns(
        {
            "reachable": F.coalesce(success | status.isin(401, 403), F.lit(False)),
            "fetch_error": label,
            "retry_after_days": F.when(dns | status.isin(404, 410), 30),
            "retry_after_hours": F.when(status == 429, F.coalesce(wait, F.lit(24))).when(
                (status >= 500) | (unanswered & ~dns & ~refused & error.isNotNull()),
                failed_retry_hours,
            ),
            "has_html": F.coalesce(html_page, F.lit(False)),
        }
    )


def page_content(pages: DataFrame, html: str = "html") -> DataFrame:
    """Normalised text and digit string of each whole page, made once before any join."""
    normalized = pages.withColumn("content", normalize_text(F.col(html)))
    return normalized.withColumn("content_digits", digits(F.col("content")))

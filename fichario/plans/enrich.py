"""Enrichment job: candidates x fetched pages -> enrichment state.

The per-company lookups of a row-at-a-time enrichment become joins; everything else is column
expressions. Page text is reduced to signals and normalised content before any shuffle, and the
content leaves the rows as soon as the ownership score is known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import contacts as C
from fichario.functions import scoring as S
from fichario.operators import contacts, leads, pages, queue, sites, skew
from fichario.session import made_first

# Signals taken from the landing page alone.
_LANDING_ONLY = ("has_customer_login", "has_contact_form", "coming_soon")
# Signals the inner pages of a valid site may add.
_MERGED = (
    "has_product_page", "has_product_schema", "has_price", "has_cart", "has_checkout",
    "has_add_to_cart", "has_catalog", "has_search", "has_chat",
)
_PLATFORM = ("plataforma", "plataforma_confianca", "plataformas_detectadas")
_SITE_FIELDS = (
    "status", "final_url", "content_type", "redirect_count", "reachable", "has_html", "host",
    "site_titulo", "whatsapp", "instagram_url", "linkedin_url", "chat_provider", *_PLATFORM,
    *_MERGED, *_LANDING_ONLY,
)
_PAGE_FIELDS = (*_SITE_FIELDS, "fetch_error", "retry_after_days", "retry_after_hours")
ATTEMPT_FIELDS = (
    *_PAGE_FIELDS, "candidate_url", "candidate_source", "site_match_score",
    "site_validation_reasons", "site_match_status", "site_valid", "cnpj_on_site",
)


# Stored columns of a place: the column of the search result and its type.
_PLACE_DETAILS = {
    "google_place_id": ("place_id", "string"),
    "google_place_name": ("display_name", "string"),
    "google_place_address": ("formatted_address", "string"),
    "google_place_phone": ("national_phone", "string"),
    "google_place_website": ("website", "string"),
    "google_rating": ("rating", "double"),
    "google_rating_count": ("rating_count", "int"),
    "google_maps_url": ("maps_url", "string"),
    "google_business_status": ("business_status", "string"),
}


def analyze_pages(fetched: DataFrame) -> DataFrame:
    """Facts of every fetched URL: outcome, signals and normalised content.

    ``fetched``: url, status, content_type, error, retry_after, redirect_count, html. Only HTML
    pages answered with success are read. A map-only job; save its result to use it twice.
    """
    log = pages.fetch_outcome(fetched).withColumn(
        "has_html", F.col("has_html") & (F.coalesce(F.length("html"), F.lit(0)) > 0)
    )
    html = F.when(F.col("has_html"), F.col("html"))
    read = pages.page_content(log.withColumn("html", html))
    facts = pages.page_signals(read)
    has_final = F.col("has_html") | (F.col("status") == 403) | (F.col("status") == 401)
    other_type = F.col("fetch_error") == "conteudo_nao_html"
    return facts.withColumns(
        {
            "url_key": sites.url_key(F.col("url")),
            "final_url": F.when(has_final | other_type, F.col("url")),
        }
    )


def profile(
    candidates: DataFrame,
    partners: DataFrame,
    providers: DataFrame | None = None,
    places: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
    state: DataFrame | None = None,
    now: Column | None = None,
    lay: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """What is known about each candidate before looking at sites; ``state`` holds the companies
    enriched earlier, whose e-mail domains count as well and whose fresh places are kept. With ``lay``,
    which lays rows out by ``cnpj``, candidates, providers and places already lie so."""
    rows = contacts.profile_contacts(candidates, partners, hot_rows, state, lay).withColumns(
        {
            "site_url": F.lit(None).cast("string"),
            "site_source": F.lit(None).cast("string"),
            "retry_reason": F.lit(None).cast("string"),
            "google_place_match_score": F.lit(0),
            "google_business_status": F.lit(None).cast("string"),
        }
    )
    if providers is not None:
        rows = sites.overlay_provider(rows, providers)
    if places is not None:
        rows = _overlay_places(rows, places, hot_rows, state, now, candidates, lay)
    return rows


def _overlay_places(
    rows: DataFrame, places: DataFrame, hot_rows: int, state: DataFrame | None, now: Column | None,
    companies: DataFrame | None = None, lay: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The place of each company with its details; its website takes precedence over any other site.

    A place of ``state`` whose check is still fresh (R5) is kept as it was, check time included; the
    other companies take the best of the searched ``places``, checked ``now``. ``companies``, where given,
    are the same companies before anything was joined to them: places are scored by their columns, so that
    the joins behind ``rows`` are not made twice.
    """
    names = [*_PLACE_DETAILS, "google_place_match_score", "google_places_checked_at"]
    searched = places
    cached = None
    if state is not None and now is not None and {"google_place_id", "google_places_checked_at"} <= set(state.columns):
        cached = state.filter(queue.place_is_cached(now)).select(
            "cnpj", *[c for c in names if c in state.columns]
        )
        searched = places.join(cached.select("cnpj"), "cnpj", "left_anti")
    best = sites.best_places(sites.place_scores(
        searched, rows if companies is None else companies, hot_rows if lay is None else None))
    found = best.select(
        "cnpj",
        "google_place_match_score",
        *[
            (F.col(source) if source in best.columns else F.lit(None)).cast(kind).alias(name)
            for name, (source, kind) in _PLACE_DETAILS.items()
        ],
        (F.lit(None) if now is None else now).cast("timestamp").alias("google_places_checked_at"),
    )
    if cached is not None:
        found = found.unionByName(cached, allowMissingColumns=True)
    known = found.select("cnpj", *[F.col(c).alias(f"_{c}") for c in names])
    if lay is not None:
        known = lay(known)
    website = F.nullif(F.col("_google_place_website"), F.lit(""))
    return rows.drop(*names).join(known, "cnpj", "left").withColumns(
        {
            "google_place_match_score": F.coalesce("_google_place_match_score", F.lit(0)),
            "google_places_checked_at": F.col("_google_places_checked_at"),
            **{c: F.col(f"_{c}") for c in _PLACE_DETAILS},
            "site_url": F.coalesce(website, "site_url"),
            "site_source": F.when(website.isNotNull(), "google_places").otherwise(F.col("site_source")),
            "retry_reason": F.when(
                F.col("_google_place_match_score").isNull() & F.col("_google_place_id").isNull(),
                "google_places_no_result",
            ),
        }
    ).drop(*[f"_{c}" for c in names])


def match_sites(
    profiled: DataFrame,
    facts: DataFrame,
    threshold: int = K.SITE_MATCH_THRESHOLD,
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """Every attempted URL of every candidate with its ownership score."""
    tried = sites.match_names(sites.site_candidates(profiled)).select(
        "cnpj", "attempt", "candidate_url", "candidate_source", "url_key", "email_tipo",
        "email_dominio", "uf", "domain_shared_count", "_fantasia", "_razao", "_municipio",
        "_telefone", "_cnpj",
    )
    fetched = sites.latest_fetches(facts).select(
        "url_key", *_PAGE_FIELDS, "content", "content_digits"
    )
    scored = sites.site_ownership(sites.join_pages(tried, fetched, hot_rows), threshold)
    read = F.col("has_html") & F.col("reachable")
    # Made first: a filter by a score would take a copy of all searches of the page's text that make it.
    return made_first(scored.withColumns(
        {
            name: F.when(read, F.col(name))
            for name in (
                "site_match_score", "site_validation_reasons", "site_match_status", "site_valid",
                "cnpj_on_site",
            )
        }
    ))


def decide_sites(attempts: DataFrame) -> DataFrame:
    """W5 for the attempts of ``match_sites``: one row per company.

    Attempts count in order up to the first that stops. Of those the last answered one gives the
    site, the last with an ownership score the match, the last failed one the error. The choices are
    aggregates over (company, attempt), which is unique, so the result does not depend on row order.
    """
    stop = F.col("status").isNotNull() & (
        S.flag("site_valid")
        | (F.coalesce(F.col("site_match_status"), F.lit("")) == "rejected_webmail")
        | F.col("status").isin(404, 410)
    )
    stops = attempts.groupBy("cnpj").agg(F.min(F.when(stop, F.col("attempt"))).alias("_until"))
    made = attempts.join(stops, "cnpj").filter(
        F.col("_until").isNull() | (F.col("attempt") <= F.col("_until"))
    )
    row = F.struct(*[c for c in attempts.columns if c in ATTEMPT_FIELDS])

    def last(name: str) -> Column:
        return F.max_by(row, F.when(F.col(name).isNotNull(), F.col("attempt")))

    decided = made.groupBy("cnpj").agg(
        last("status").alias("_site"),
        last("site_match_status").alias("_match"),
        last("fetch_error").alias("_error"),
        F.coalesce(F.bool_or("cnpj_on_site"), F.lit(False)).alias("cnpj_on_site"),
    )
    match = ("site_match_score", "site_validation_reasons", "site_match_status", "site_valid")
    failure = ("fetch_error", "retry_after_days", "retry_after_hours")
    return decided.select(
        "cnpj",
        F.col("_site").isNotNull().alias("answered"),
        *[f"_site.{c}" for c in ("candidate_url", "candidate_source", *_SITE_FIELDS)],
        *[f"_match.{c}" for c in match],
        *[f"_error.{c}" for c in failure],
        "cnpj_on_site",
    )


def merge_rollup(rows: DataFrame, rollup: DataFrame) -> DataFrame:
    """Inner pages of a valid site add their signals; a surer platform replaces the first."""
    inner = rollup.select(
        F.col("host").alias("_host"),
        F.col("chat_provider").alias("_chat"),
        *[F.col(name).alias(f"_{name}") for name in (*_MERGED, *_PLATFORM)],
    )
    joined = rows.join(inner, S.flag("site_valid") & (F.col("host") == F.col("_host")), "left")
    surer = S.present("_plataforma") & (
        S.number("_plataforma_confianca") > S.number("plataforma_confianca")
    )
    return joined.withColumns(
        {
            **{name: S.flag(name) | S.flag(f"_{name}") for name in _MERGED},
            "chat_provider": F.coalesce("chat_provider", "_chat"),
            **{c: F.when(surer, F.col(f"_{c}")).otherwise(F.col(c)) for c in _PLATFORM},
        }
    ).drop("_host", "_chat", *[f"_{c}" for c in (*_MERGED, *_PLATFORM)])


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def site_signals(profiled: DataFrame, decided: DataFrame, rollup: DataFrame) -> DataFrame:
    """Company rows with the signals of their deciding page and site."""
    rows = profiled.join(decided, "cnpj", "left")
    answered = S.flag("answered")
    rows = rows.withColumns(
        {
            "site_url": F.when(answered, F.coalesce("final_url", "candidate_url")).otherwise(
                F.col("site_url")
            ),
            "site_source": F.when(answered, F.col("candidate_source")).otherwise(
                F.col("site_source")
            ),
            "site_http_status": F.col("status"),
            "site_final_url": F.col("final_url"),
            "site_content_type": F.col("content_type"),
            "site_redirect_count": F.coalesce("redirect_count", F.lit(0)),
            "site_reachable": S.flag("reachable"),
            "site_ativo": S.flag("reachable"),
            "site_titulo": F.nullif(F.col("site_titulo"), F.lit("")),
            "site_valid": S.flag("site_valid") & ~F.coalesce(F.col("status").isin(404, 410), F.lit(False)),
            "site_match_score": S.number("site_match_score"),
            "site_validation_reasons": F.coalesce("site_validation_reasons", _no_texts()),
            "has_html": S.flag("has_html") & S.flag("reachable"),
            "cnpj_on_site": S.flag("cnpj_on_site"),
        }
    )
    read = F.col("has_html")
    rows = rows.withColumns(
        {
            **{name: S.flag(name) & read for name in (*_MERGED, *_LANDING_ONLY)},
            **{c: F.when(read, F.col(c)) for c in ("chat_provider", "instagram_url", "linkedin_url", *_PLATFORM)},
            "whatsapp_detected": F.coalesce(F.col("whatsapp.detected"), F.lit(False)) & read,
        }
    )
    detected = F.col("whatsapp_detected")
    rows = merge_rollup(rows, rollup).withColumns(
        {
            "plataforma_confianca": S.number("plataforma_confianca"),
            "plataformas_detectadas": F.coalesce("plataformas_detectadas", _no_texts()),
            "whatsapp_valid": detected & F.col("whatsapp.valid"),
            "whatsapp_number": F.when(detected, F.col("whatsapp.number")),
            "whatsapp_number_normalized": F.when(detected, F.col("whatsapp.normalized")),
            "whatsapp_url": F.when(detected, F.col("whatsapp.canonical_url")),
            "whatsapp_source": F.when(detected, "website"),
            "whatsapp_confidence": F.when(detected, F.col("whatsapp.confidence")).otherwise(0),
        }
    )
    confirmed = S.flag("whatsapp_valid")
    return rows.withColumn(
        "telefone_candidato_whatsapp",
        F.when(~confirmed, C.whatsapp_candidate(F.col("telefone_1"))),
    ).drop(
        "answered", "candidate_url", "candidate_source", "status", "final_url", "content_type",
        "redirect_count", "reachable", "whatsapp", "host",
    )


def enrich(
    candidates: DataFrame,
    partners: DataFrame,
    facts: DataFrame,
    now: Column,
    providers: DataFrame | None = None,
    places: DataFrame | None = None,
    priority_cnaes=(),
    mei_penalty: int = 0,
    threshold: int = K.SITE_MATCH_THRESHOLD,
    version: str = K.ENRICHMENT_VERSION,
    hot_rows: int = skew.HOT_ROWS,
    save: Callable[[str, DataFrame], DataFrame] | None = None,
    state: DataFrame | None = None,
    lay: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """New enrichment state of every candidate, ready for the S13 merge.

    ``facts`` is the (saved) result of ``analyze_pages``; ``candidates`` may carry
    ``enrich_attempts`` of the previous state. ``save`` writes a stage to the shared folder and
    returns the table read back; ``state`` (cnpj, email_dominio) is what is stored from earlier runs.
    Profile and attempts are used twice, and a lost executor then repeats one
    stage instead of the whole chain. Where candidates, providers, places and what ``save`` returns lie by
    ``cnpj``, ``lay`` lays other rows out the same way; then only keys and what was found by them move.
    """
    save = save or (lambda _, rows: rows)
    profiled = save("profile", profile(candidates, partners, providers, places, hot_rows, state, now, lay))
    attempts = save("attempts", match_sites(profiled, facts, threshold, hot_rows))
    decided = save("decided_sites", decide_sites(attempts))
    rollup = save("site_rollup", pages.site_rollup(facts.filter("has_html")))
    rows = leads.enrich_status(site_signals(profiled, decided, rollup))
    rows = rows.withColumns(
        {
            "email_original": F.col("email"),
            "faixa_faturamento_estimada": F.col("faixa_porte_receita"),
            "faturamento_fonte": F.col("porte_receita_fonte"),
            "enrich_error": F.when(F.col("enrich_status") == "failed", F.col("fetch_error")),
            "enrichment_version": F.lit(version),
            "last_attempt_at": now,
            "site_last_checked_at": now,
        }
    )
    if "enrich_attempts" not in rows.columns:
        rows = rows.withColumn("enrich_attempts", F.lit(0))
    scored = leads.score_leads(queue.count_attempt(rows), priority_cnaes, mei_penalty)
    return queue.next_retry(scored, now).withColumn(
        "sinais", F.struct("email_normalizado", "porte", "opcao_mei", "cnpj_on_site")
    )

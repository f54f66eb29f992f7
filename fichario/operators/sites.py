"""Matching companies to sites, places and provider records."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from fichario import constants as K
from fichario.functions import urls
from fichario.functions.contacts import is_free_domain
from fichario.functions.scoring import clamp, first_of, points
from fichario.functions.text import digits, held, normalize_text, normalize_word, tail
from fichario.operators import skew


# Similarities from which a trade or legal name counts as the place's.
TRADE_FLOOR, LEGAL_FLOOR = 0.75, 0.70


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def url_key(url: Column) -> Column:
    """Join key of a URL: host, path and query; scheme, credentials and fragment do not count."""
    place = F.lower(F.regexp_replace(urls.authority(url), "^.*@", ""))
    path = F.coalesce(F.nullif(urls.path(url), F.lit("")), F.lit("/"))
    return F.concat(place, path, F.regexp_extract(url, r"(\?[^#]*)", 1))


def site_candidates(companies: DataFrame) -> DataFrame:
    """The URLs to try per company, in order; at most three rows per company.

    A site already known (place or provider) comes first, then the corporate e-mail domain.
    """
    domain = F.col("email_dominio")
    from_email = (F.col("email_tipo") == "corporativo") & (domain != "") & ~is_free_domain(domain)

    def candidate(condition: Column, url: Column, source: Column) -> tuple[Column, Column]:
        return condition, F.struct(url.alias("url"), source.alias("source"))

    by_email = F.lit("corporate_email_domain")
    known_source = F.coalesce(F.nullif(F.col("site_source"), F.lit("")), F.lit("external_provider"))
    listed = held(
        candidate(_text("site_url") != "", F.col("site_url"), known_source),
        candidate(from_email, F.concat(F.lit("https://"), domain, F.lit("/")), by_email),
        candidate(from_email, F.concat(F.lit("https://www."), domain, F.lit("/")), by_email),
        kind="struct<url:string,source:string>",
    )
    # The outer form keeps the optimizer from repeating the whole list in a size filter.
    exploded = companies.select("*", F.posexplode_outer(listed).alias("attempt", "_candidate"))
    return exploded.filter(F.col("_candidate").isNotNull()).select(
        *companies.columns,
        "attempt",
        F.col("_candidate.url").alias("candidate_url"),
        F.col("_candidate.source").alias("candidate_source"),
        url_key(F.col("_candidate.url")).alias("url_key"),
    )


def latest_fetches(pages: DataFrame) -> DataFrame:
    """One row per ``url_key``: the latest fetch by ``fetched_at`` where the log has it; then the
    answered ones, the best status, HTTPS before HTTP, a hash of the page and, where the log numbers
    its fetches, the smallest ``page_id`` decide."""
    status, moment = F.col("status"), F.lit(None).cast("timestamp")
    if "fetched_at" in pages.columns:
        moment = F.col("fetched_at")
    number = [F.col("page_id")] if "page_id" in pages.columns else []
    rank = Window.partitionBy("url_key").orderBy(
        moment.desc_nulls_last(), status.isNull(), F.when(status.between(200, 299), 0).otherwise(1),
        status, F.col("url").desc(), F.xxhash64("content"), *number,
    )
    return pages.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank")


def join_pages(
    candidates: DataFrame, pages: DataFrame, hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Attempts joined to the fetched pages; a domain shared by very many companies is spread.

    ``pages`` has one row per ``url_key``: see ``latest_fetches``.
    """
    return skew.spread_join(
        candidates, pages, "url_key", ["cnpj", "attempt"], "inner", hot_rows=hot_rows
    )


def match_names(companies: DataFrame) -> DataFrame:
    """Company-side values of the ownership score, made once per company before the join."""
    return companies.withColumns(
        {
            "_fantasia": normalize_text(F.col("nome_fantasia")),
            "_razao": normalize_text(F.col("razao_social")),
            "_municipio": normalize_text(F.col("municipio_descricao")),
            "_telefone": tail(digits(_text("telefone_1")), 10),
            "_cnpj": digits(_text("cnpj")),
        }
    )


def is_social_host(host: Column) -> Column:
    """The host is a social network or one of its subdomains."""
    social = F.lit(False)
    for name in K.SOCIAL_HOSTS:
        social = social | (host == name) | F.endswith(host, F.lit("." + name))
    return F.coalesce(social, F.lit(False))


def site_ownership(attempts: DataFrame, threshold: int = K.SITE_MATCH_THRESHOLD) -> DataFrame:
    """G9 + G10: how surely a page belongs to the company, with reasons and status.

    Expects ``match_names`` columns, the page's ``host``, ``site_titulo``, ``content`` and
    ``content_digits``, and ``domain_shared_count``.
    """
    host, content = F.col("host"), F.col("content")
    attempts = attempts.withColumn("_title", normalize_text(F.col("site_titulo")))
    in_title = {
        word: F.contains(F.col("_title"), F.lit(normalize_word(word)))
        for word in sorted(K.INCOMPATIBLE_TITLES)
    }

    def in_content(value: Column, min_length: int) -> Column:
        return (F.length(value) >= min_length) & F.contains(content, value)

    padded = F.concat(F.lit(" "), content, F.lit(" "))
    state = F.concat(F.lit(" "), F.lower(F.col("uf")), F.lit(" "))
    by_trade_name = in_content(F.col("_fantasia"), 4)
    by_legal_name = ~by_trade_name & in_content(F.col("_razao"), 6)
    by_city = in_content(F.col("_municipio"), 1)
    by_state = (_text("uf") != "") & F.contains(padded, state)
    by_phone = (F.col("_telefone") != "") & F.contains(F.col("content_digits"), F.col("_telefone"))
    by_key = (F.length("_cnpj") == 14) & F.contains(F.col("content_digits"), F.col("_cnpj"))
    by_domain = (
        (F.col("email_tipo") == "corporativo")
        & (_text("email_dominio") != "")
        & F.contains(host, F.col("email_dominio"))
    )
    shared = F.coalesce(F.col("domain_shared_count"), F.lit(0))
    evidence = [
        *[(f"title_incompativel:{word}", hit, -30) for word, hit in in_title.items()],
        ("nome_fantasia_no_conteudo", by_trade_name, 30),
        ("razao_social_no_conteudo", by_legal_name, 20),
        ("municipio_no_conteudo", by_city, 10),
        ("uf_no_conteudo", by_state, 10),
        ("telefone_coincide", by_phone, 15),
        ("cnpj_no_site", by_key, 20),
        ("dominio_email_coincide", by_domain, 15),
        ("dominio_compartilhado", shared >= 3, -30),
        ("dominio_possivelmente_compartilhado", (shared >= 1) & (shared < 3), -10),
    ]
    score = clamp(points(*[(hit, n) for _, hit, n in evidence]))
    reasons = held(*[(hit, F.lit(reason)) for reason, hit, _ in evidence])

    webmail = (F.col("email_tipo") == "gratuito") | is_free_domain(F.col("email_dominio"))
    early = (
        F.when(webmail, F.struct(F.lit("webmail_domain").alias("r"), F.lit("rejected_webmail").alias("s")))
        .when(
            host.isin(*K.FREE_EMAIL_DOMAINS),
            F.struct(F.lit("webmail_redirect").alias("r"), F.lit("rejected_webmail").alias("s")),
        )
        .when(
            is_social_host(host),
            F.struct(F.lit("redirect_social").alias("r"), F.lit("redirect_social").alias("s")),
        )
    )
    scored = attempts.withColumns({"_early": early, "_score": score, "_reasons": reasons})
    stopped = F.col("_early").isNotNull()
    level = (
        F.when(F.col("_score") >= 70, "validated")
        .when(F.col("_score") >= 40, "partial_match")
        .otherwise("unverified")
    )
    return (
        scored.withColumns(
            {
                "site_match_score": F.when(stopped, 0).otherwise(F.col("_score")),
                "site_validation_reasons": F.when(stopped, F.array("_early.r")).otherwise(
                    F.col("_reasons")
                ),
                "site_match_status": F.when(stopped, F.col("_early.s")).otherwise(level),
            }
        )
        .withColumns(
            {
                "site_valid": (F.col("site_match_score") >= threshold)
                & (F.col("site_match_status") == "validated"),
                "cnpj_on_site": F.array_contains("site_validation_reasons", "cnpj_no_site"),
            }
        )
        .drop("_early", "_score", "_reasons", "_fantasia", "_razao", "_municipio", "_telefone",
              "_cnpj", "_title", "content", "content_digits")
    )


def best_attempts(attempts: DataFrame, fields: list[str]) -> DataFrame:
    """The attempt that decides each company.

    Attempts count in order until one is valid, webmail, 404 or 410; without such a stop the last
    attempt with an HTTP status decides. Needs ``cnpj``, ``attempt``, ``status``, ``site_valid``,
    ``site_match_status``. Both choices are aggregates, so no company's attempts are collected.
    """
    answered = F.col("status").isNotNull()
    stop = answered & (
        F.coalesce(F.col("site_valid"), F.lit(False))
        | (_text("site_match_status") == "rejected_webmail")
        | F.col("status").isin(404, 410)
    )
    row = F.struct("attempt", *fields)
    chosen = attempts.groupBy("cnpj").agg(
        F.min_by(row, F.when(stop, F.col("attempt"))).alias("_stop"),
        F.max_by(row, F.when(answered, F.col("attempt"))).alias("_last"),
    )
    return (
        chosen.withColumn("_row", F.coalesce("_stop", "_last"))
        .filter(F.col("_row").isNotNull())
        .select("cnpj", "_row.*")
    )


@F.pandas_udf(StructType().add("trade", DoubleType()).add("legal", DoubleType()))
def _ratios(display: pd.Series, trade: pd.Series, legal: pd.Series) -> pd.DataFrame:
    """Sequence similarity of a name to a trade and a legal name; NULL where no comparison is wanted.
    The legal name is compared only where the trade name does not reach TRADE_FLOOR."""

    def ratio(a: str | None, b: str | None) -> float | None:
        return None if a is None or b is None else SequenceMatcher(None, a, b).ratio()

    rows = []
    for name, first, second in zip(display, trade, legal):
        found = ratio(name, first)
        rows.append((found, ratio(name, second) if found is None or found < TRADE_FLOOR else None))
    return pd.DataFrame(rows, columns=["trade", "legal"], dtype="float64")


def _open_case(a: Column, b: Column, floor: float) -> Column:
    """Pairs that only the full comparison settles: not equal, and the ratio, at most 2 * shorter /
    (both lengths), can reach ``floor``."""
    sizes = F.length(a) + F.length(b)
    return (a != b) & (2.0 * F.least(F.length(a), F.length(b)) >= floor * sizes)


def name_similarity(a: Column, b: Column, floor: float) -> Column:
    """Similarity of two normalised names where it can reach ``floor``, else 0; equal names are 1."""
    open_case = _open_case(a, b, floor)
    none = F.lit(None).cast("string")
    ratio = _ratios(F.when(open_case, a), F.when(open_case, b), none)["trade"]
    return F.when(a == b, 1.0).otherwise(F.coalesce(ratio, F.lit(0.0)))


def with_similarities(pairs: DataFrame) -> DataFrame:
    """``_trade`` and ``_legal``, the similarities of ``_display`` to ``_fantasia`` and ``_razao``, by
    one call per pair. The legal name counts only where the trade name does not."""
    display, trade, legal = F.col("_display"), F.col("_fantasia"), F.col("_razao")
    equal = F.coalesce(display == trade, F.lit(False))
    first = _open_case(display, trade, TRADE_FLOOR)
    second = _open_case(display, legal, LEGAL_FLOOR) & ~equal
    compared = pairs.withColumn(
        "_ratios", _ratios(
            F.when(F.coalesce(first, F.lit(False)) | F.coalesce(second, F.lit(False)), display),
            F.when(first, trade), F.when(second, legal)))
    found = compared.withColumn(
        "_trade", F.when(equal, 1.0).otherwise(F.coalesce("_ratios.trade", F.lit(0.0))))
    similar = F.when(display == legal, 1.0).otherwise(F.coalesce("_ratios.legal", F.lit(0.0)))
    return found.withColumn(
        "_legal", F.when(F.col("_trade") < TRADE_FLOOR, similar).otherwise(0.0)).drop("_ratios")


def place_scores(
    places: DataFrame, companies: DataFrame, hot_rows: int | None = skew.HOT_ROWS
) -> DataFrame:
    """Match score of every (company, place) pair.

    ``places``: cnpj, position (order of the search result), place_id, display_name,
    formatted_address, national_phone and further place columns. Without ``hot_rows`` nothing is counted
    or salted: places that lie by cnpj then meet their company where they lie.
    """
    def name(column: str) -> Column:
        """Normalised name; an empty one is NULL and similar to nothing."""
        return F.when(_text(column) != "", normalize_text(F.col(column)))

    # The company's side is made once per company, before the join copies it to each of its places.
    names = companies.select(
        "cnpj",
        name("nome_fantasia").alias("_fantasia"),
        name("razao_social").alias("_razao"),
        normalize_text(F.col("municipio_descricao")).alias("_city"),
        F.lower(_text("uf")).alias("_uf"),
        F.when(_text("logradouro") != "", F.left(normalize_text(F.col("logradouro")), F.lit(20))).alias("_street"),
        F.replace(_text("cep"), F.lit("-"), F.lit("")).alias("_postal"),
        (_text("cep") != "").alias("_has_postal"),
        tail(digits(_text("telefone_1")), 10).alias("_phone"),
    )
    pairs = (
        places.join(names, "cnpj") if hot_rows is None
        else skew.spread_join(places, names, "cnpj", ["place_id"], hot_rows=hot_rows)
    )
    prepared = with_similarities(pairs.withColumns(
        {"_display": name("display_name"), "_address": normalize_text(F.col("formatted_address"))}
    ))
    address, city, state = F.col("_address"), F.col("_city"), F.col("_uf")
    address_digits = digits(_text("formatted_address"))
    place_phone = tail(digits(_text("national_phone")), 10)
    padded = F.concat(F.lit(" "), address, F.lit(" "))
    score = first_of((F.col("_trade") >= TRADE_FLOOR, 30), (F.col("_legal") >= LEGAL_FLOOR, 20)) + points(
        ((city != "") & F.contains(address, city), 10),
        ((city != "") & ~F.contains(address, city), -40),
        ((state != "") & F.contains(padded, F.concat(F.lit(" "), state, F.lit(" "))), 10),
        (F.coalesce(F.contains(address, F.col("_street")), F.lit(False)), 10),
        (F.col("_has_postal") & F.contains(address_digits, F.col("_postal")), 10),
        ((place_phone != "") & (place_phone == F.col("_phone")), 15),
    )
    return prepared.select(*places.columns, clamp(score).alias("match_score"))


def best_places(scored: DataFrame, floor: int = K.PLACE_MATCH_THRESHOLD) -> DataFrame:
    """Best place per company, first search result on ties; details only at or above floor."""
    details = [c for c in scored.columns if c not in ("cnpj", "match_score", "position")]
    best = scored.groupBy("cnpj").agg(
        F.max_by(
            F.struct("match_score", *details), F.struct("match_score", -F.col("position"))
        ).alias("_best")
    )
    enough = F.col("_best.match_score") >= floor
    return best.select(
        "cnpj",
        F.col("_best.match_score").alias("google_place_match_score"),
        *[F.when(enough, F.col(f"_best.{c}")).alias(c) for c in details],
    )


def overlay_provider(companies: DataFrame, records: DataFrame) -> DataFrame:
    """Provider site and decision maker only where none is known; revenue band if given."""
    blank_site = _text("site_url") == ""
    provided = records.select(
        "cnpj",
        F.nullif(F.col("website"), F.lit("")).alias("_website"),
        F.coalesce(
            F.nullif(F.col("faixa_faturamento_empresa"), F.lit("")),
            F.nullif(F.col("faixa_faturamento_cnpj"), F.lit("")),
        ).alias("_band"),
        F.nullif(F.col("administrador"), F.lit("")).alias("_admin"),
    )
    joined = companies.join(provided, "cnpj", "left")
    use_site = blank_site & F.col("_website").isNotNull()
    return joined.withColumns(
        {
            "site_url": F.when(use_site, F.col("_website")).otherwise(F.col("site_url")),
            "site_source": F.when(use_site, "external_provider").otherwise(F.col("site_source")),
            "faturamento_estimado": F.col("_band"),
            "faturamento_estimado_fonte": F.when(F.col("_band").isNotNull(), "speedio"),
            "decisor_nome": F.when(_text("decisor_nome") == "", F.coalesce("_admin", "decisor_nome"))
            .otherwise(F.col("decisor_nome")),
        }
    ).drop("_website", "_band", "_admin")

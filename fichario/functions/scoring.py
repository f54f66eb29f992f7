"""Score rules Q1-Q6 as Columns over the enrichment state columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions.pages import strong_commerce


def flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def present(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), c)).cast("int")


def points(*terms: tuple[Column, int]) -> Column:
    """Sum of the points whose condition holds."""
    return reduce(lambda a, b: a + b, [F.when(cond, n).otherwise(0) for cond, n in terms])


def first_of(*terms: tuple[Column, int]) -> Column:
    """Points of the first condition that holds, else 0."""
    rule = F
    for cond, n in terms:
        rule = rule.when(cond, n)
    return rule.otherwise(0)


def band(score: Column, otherwise: str, *levels: tuple[int, str]) -> Column:
    """Label of the first level whose floor the score reaches."""
    rule = F
    for floor, label in levels:
        rule = rule.when(score >= floor, label)
    return rule.otherwise(otherwise)


def is_corporate() -> Column:
    return F.coalesce(F.col("email_tipo"), F.lit("")) == "corporativo"


def presence_score() -> Column:
    """Q1."""
    open_place = F.coalesce(F.col("google_business_status"), F.lit("")) == "OPERATIONAL"
    return clamp(
        first_of((flag("site_valid"), 30), (flag("site_reachable"), 10))
        + first_of((flag("whatsapp_valid"), 20), (flag("whatsapp_detected"), 3))
        + points(
            (is_corporate(), 15),
            (present("instagram_url"), 15),
            (present("linkedin_url"), 10),
            ((number("google_place_match_score") >= K.PLACE_MATCH_THRESHOLD) & open_place, 10),
        )
    )


def presence_maturity(score: Column) -> Column:
    return band(
        score, "offline",
        (70, "presenca_multicanal"), (45, "presenca_ativa"), (20, "presenca_basica"),
    )


def commerce_score() -> Column:
    """Q2."""
    confidence = number("plataforma_confianca")
    total = first_of((confidence >= 80, 20), (confidence >= 50, 10), (present("plataforma"), 5))
    total = total + points(
        (flag("has_product_schema"), 20),
        (flag("has_product_page"), 15),
        (flag("has_price"), 10),
        (flag("has_add_to_cart"), 15),
        (flag("has_cart"), 10),
        (flag("has_checkout"), 10),
        (flag("has_catalog") & ~flag("has_checkout"), 5),
    )
    return clamp(F.when(flag("coming_soon"), F.least(total, F.lit(25))).otherwise(total))


def commerce_maturity(score: Column) -> Column:
    confirmed = (score >= 60) & strong_commerce(F.col)
    return F.when(confirmed, "ecommerce_confirmado").otherwise(
        band(score, "sem_ecommerce", (40, "ecommerce_provavel"), (20, "ecommerce_indicio"))
    )


def fit_score(priority_cnaes=(), mei_penalty: int = 0) -> Column:
    """Q3; needs commerce_maturity."""
    maturity = F.coalesce(F.col("commerce_maturity"), F.lit(""))
    priority = F.col("cnae_fiscal_principal").isin(*priority_cnaes) if priority_cnaes else F.lit(False)
    return clamp(
        first_of((F.coalesce(priority, F.lit(False)), 30), (present("cnae_fiscal_principal"), 10))
        + first_of((F.col("porte") == "03", 15), (F.col("porte") == "05", 20))
        + first_of((maturity == "ecommerce_confirmado", 20), (maturity == "ecommerce_provavel", 10))
        + points((flag("has_catalog"), 10), (F.col("opcao_mei") == "S", -mei_penalty))
    )


def pain_score() -> Column:
    """Q4; needs commerce_score. A site that already has a chat feels no pain."""
    channels = points(
        (flag("whatsapp_valid"), 1), (present("instagram_url"), 1), (is_corporate(), 1),
        (flag("site_valid"), 1),
    )
    total = points(
        (flag("whatsapp_valid"), 20),
        (flag("site_valid"), 15),
        (number("commerce_score") >= 40, 20),
        (flag("has_contact_form"), 10),
        (channels >= 2, 10),
    )
    return clamp(F.when(flag("has_chat"), 0).otherwise(total))


def incompatible_title() -> Column:
    reasons = F.array_join(F.coalesce(F.col("site_validation_reasons"), F.array()), " ")
    return F.contains(reasons, F.lit("title_incompativel"))


def confidence_score() -> Column:
    """Q5."""
    return clamp(
        first_of((flag("site_valid"), 25), (flag("site_reachable"), 5))
        + points(
            (number("google_place_match_score") >= K.PLACE_MATCH_THRESHOLD, 20),
            (flag("telefone_match"), 15),
            (is_corporate() & flag("site_valid"), 15),
            (flag("whatsapp_valid"), 15),
            (flag("cnpj_on_site"), 20),
            (flag("domain_is_shared") & ~flag("cnpj_on_site"), -30),
            (F.coalesce(F.col("site_match_status"), F.lit("")) == "rejected_webmail", -100),
            (flag("whatsapp_detected") & ~flag("whatsapp_valid"), -15),
            (incompatible_title(), -50),
        )
    )


def lead_score() -> Column:
    """Q6: weighted sum rounded half to even (``round`` would round half up)."""
    weighted = (
        number("fit_score") * 0.40 + number("pain_score") * 0.35 + number("confidence_score") * 0.25
    )
    return clamp(F.rint(weighted))


def lead_class(score: Column) -> Column:
    return band(
        score, "lead_frio", (80, "lead_prioritario"), (60, "lead_quente"), (40, "lead_medio")
    )

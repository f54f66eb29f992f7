"""Score and qualification jobs: enrichment status (G13), scores (Q7, Q8), qualification (Q9, Q10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import scoring as S
from fichario.functions.contacts import contact_channel
from fichario.functions.pages import strong_commerce
from fichario.functions.text import held
from fichario.operators.views import rescore_input
from fichario.session import made_first

SCORE_COLUMNS = (
    "presence_score", "presence_maturity", "commerce_score", "commerce_maturity", "fit_score",
    "pain_score", "confidence_score", "lead_score", "lead_classification", "digital_score",
    "digital_maturity", "score_version",
)

# Columns the score rules read; a missing one counts as unknown (NULL).
_INPUTS = {
    "boolean": (
        "site_valid", "site_reachable", "whatsapp_valid", "whatsapp_detected", "has_product_schema",
        "has_product_page", "has_price", "has_add_to_cart", "has_cart", "has_checkout",
        "has_catalog", "has_contact_form", "has_chat", "coming_soon", "cnpj_on_site",
        "telefone_match", "domain_is_shared",
    ),
    "int": ("google_place_match_score", "plataforma_confianca"),
    "string": (
        "email_tipo", "instagram_url", "linkedin_url", "google_business_status", "plataforma",
        "cnae_fiscal_principal", "porte", "opcao_mei", "site_match_status",
    ),
    "array<string>": ("site_validation_reasons",),
}


def with_inputs(rows: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(None).cast(kind)
        for kind, names in _INPUTS.items()
        for name in names
        if name not in rows.columns
    }
    return rows.withColumns(missing) if missing else rows


def score_leads(
    rows: DataFrame, priority_cnaes=(), mei_penalty: int = 0, version: str = K.SCORE_VERSION
) -> DataFrame:
    """Q7: all scores in their order of dependence, and the legacy mirror columns."""
    scored = with_inputs(rows)
    for name, rule in (
        ("presence_score", S.presence_score()),
        ("presence_maturity", S.presence_maturity(F.col("presence_score"))),
        ("commerce_score", S.commerce_score()),
        ("commerce_maturity", S.commerce_maturity(F.col("commerce_score"))),
        ("fit_score", S.fit_score(priority_cnaes, mei_penalty)),
        ("pain_score", S.pain_score()),
        ("confidence_score", S.confidence_score()),
        ("lead_score", S.lead_score()),
        ("lead_classification", S.lead_class(F.col("lead_score"))),
        ("digital_score", F.col("lead_score")),
        ("digital_maturity", F.col("commerce_maturity")),
        ("score_version", F.lit(version)),
    ):
        scored = scored.withColumn(name, rule)
    return scored


def rescore(
    state: DataFrame, candidates: DataFrame, now: Column, version: str = K.SCORE_VERSION, **rules
) -> DataFrame:
    """Q8: recompute the scores of stored rows of another version; one pass, no fetching."""
    stale = rescore_input(state, candidates, version)
    return score_leads(stale, version=version, **rules).withColumn("updated_at", now)


def enrich_status(rows: DataFrame) -> DataFrame:
    """Outcome of an enrichment attempt."""
    page_read = S.flag("has_html") & S.flag("site_reachable")
    status = (
        F.when(page_read & S.flag("site_valid") & strong_commerce(F.col), "done")
        .when(page_read, "partial")
        .when(F.coalesce(F.col("site_url"), F.lit("")) == "", "no_site")
        .when(~S.flag("site_reachable"), "failed")
        .otherwise("partial")
    )
    return rows.withColumn("enrich_status", status)


def _or_legacy(score: str) -> Column:
    """A zero or missing score falls through to the legacy score."""
    return F.coalesce(
        F.nullif(F.col(score), F.lit(0)), F.nullif(F.col("digital_score"), F.lit(0)), F.lit(0)
    ).cast("int")


def _or_text(first: str, second: str) -> Column:
    return F.coalesce(F.nullif(F.col(first), F.lit("")), F.col(second))


def with_channel(rows: DataFrame) -> DataFrame:
    """C7 as stored columns."""
    channel = contact_channel(
        _or_text("email", "email_original"),
        F.col("email_tipo"),
        F.col("whatsapp_valid"),
        F.col("whatsapp_number_normalized"),
        F.col("whatsapp_url"),
        F.col("telefone_1"),
        F.col("telefone_candidato_whatsapp"),
        F.col("instagram_url"),
    )
    # Made first, here and below: each rule names the one before several times, and would be made as often.
    return made_first(rows.withColumn("_channel", channel)).withColumns(
        {
            "contact_channel": F.col("_channel.channel"),
            "contact_value": F.col("_channel.value"),
            "contact_confidence": F.col("_channel.confidence"),
            "contact_role": F.col("_channel.role"),
        }
    ).drop("_channel")


_HARD_FAIL = "^(site_webmail|sem_canal_outreach_valido|whatsapp_nao_confirmado|instagram_nao_automatico|confidence_baixa|lead_baixo)"


def evaluate_qualification(
    rows: DataFrame, min_confidence: int = K.MIN_CONFIDENCE, min_lead: int = K.MIN_LEAD
) -> DataFrame:
    """Q9: qualification status with the reasons against and for; needs the C7 columns."""
    confidence, lead = _or_legacy("confidence_score"), _or_legacy("lead_score")
    commerce = F.coalesce(_or_text("commerce_maturity", "digital_maturity"), F.lit(""))
    site_status = F.coalesce(F.col("site_match_status"), F.lit(""))
    channel = F.coalesce(F.col("contact_channel"), F.lit(""))
    incompatible = (site_status != "") & S.incompatible_title()
    no_channel = (channel == "") | (F.col("contact_confidence") < 50)
    unproven_site = (
        ~S.flag("site_valid")
        & S.flag("site_reachable")
        & ~commerce.isin("ecommerce_confirmado", "ecommerce_provavel")
        & ~incompatible
    )

    def below(label: str, value: Column, floor: int) -> tuple[Column, Column]:
        return value < floor, F.concat(F.lit(f"{label}:"), value.cast("string"), F.lit(f"<{floor}"))

    against = held(
        (incompatible, F.lit("site_incompativel_cnae")),
        (no_channel, F.lit("sem_canal_outreach_valido")),
        (~no_channel & (channel == "whatsapp_candidato"), F.lit("whatsapp_nao_confirmado")),
        below("confidence_baixa", confidence, min_confidence),
        below("lead_baixo", lead, min_lead),
        (unproven_site, F.lit("site_nao_validado")),
        (channel == "instagram", F.lit("instagram_nao_automatico")),
    )
    in_favour = held(
        (S.present("decisor_nome"), F.lit("decisor_cadastral")),
        *[
            (channel == name, F.lit(name))
            for name in ("whatsapp_confirmado", "email_corporativo", "telefone_comercial")
        ],
        (commerce == "ecommerce_confirmado", F.lit("ecommerce_confirmado")),
    )
    webmail = site_status == "rejected_webmail"
    nothing = F.array().cast("array<string>")
    reasoned = made_first(rows.withColumns(
        {
            "rejection_reasons": F.when(webmail, F.array(F.lit("site_webmail"))).otherwise(against),
            "qualification_reasons": F.when(webmail, nothing).otherwise(in_favour),
        }
    ))
    hard = F.col("_hard")
    found = F.size(F.filter("rejection_reasons", lambda r: r.rlike(_HARD_FAIL)))
    only_instagram = (hard == 1) & F.array_contains("rejection_reasons", "instagram_nao_automatico")
    status = (
        F.when(webmail, "blocked")
        .when(only_instagram, "review_required")
        .when(hard > 0, "rejected")
        .when(F.size("rejection_reasons") > 0, "review_required")
        .otherwise("qualified")
    )
    return made_first(reasoned.withColumn("_hard", found)).withColumn("qualification_status", status).drop("_hard")


_FINISHED = ("done", "partial", "no_site", "failed")

_QUALIFIED_COLUMNS = (
    "cnpj", "cnpj_basico", "razao_social", "nome_fantasia", "uf", "municipio_descricao",
    "telefone_1", "email", "site_url", "site_final_url", "site_ativo", "plataforma",
    "whatsapp_url", "instagram_url", "linkedin_url", "digital_score", "digital_maturity",
    "presence_score", "commerce_score", "fit_score", "pain_score", "confidence_score",
    "lead_score", "presence_maturity", "commerce_maturity", "lead_classification", "decisor_nome",
    "decisor_qualificacao", "faixa_faturamento_estimada", "capital_social", "opcao_mei",
    "opcao_simples", "qualification_status", "rejection_reasons", "qualification_reasons",
    "contact_channel", "contact_value", "contact_confidence", "contact_role",
    "qualification_version", "sinais",
)


def qualification_input(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Candidates with a finished enrichment."""
    finished = state.filter(F.col("enrich_status").isin(*_FINISHED))
    own = set(candidates.columns) - {"cnpj"}
    stored = [c for c in finished.columns if c not in own]
    return candidates.join(finished.select(*stored), "cnpj")


def qualify(
    candidates: DataFrame,
    state: DataFrame,
    min_confidence: int = K.MIN_CONFIDENCE,
    min_lead: int = K.MIN_LEAD,
) -> DataFrame:
    """Q10: the qualification row of every finished candidate, ready for the S14 merge."""
    rows = with_channel(qualification_input(candidates, state))
    evaluated = evaluate_qualification(rows, min_confidence, min_lead)
    stored = evaluated.withColumns(
        {
            "whatsapp_url": F.when(S.flag("whatsapp_valid"), F.col("whatsapp_url")),
            "digital_score": F.coalesce(
                F.nullif(F.col("lead_score"), F.lit(0)), F.col("digital_score")
            ),
            "digital_maturity": _or_text("commerce_maturity", "digital_maturity"),
            "faixa_faturamento_estimada": _or_text(
                "faixa_porte_receita", "faixa_faturamento_estimada"
            ),
            "qualification_version": F.lit(K.QUALIFICATION_VERSION),
        }
    )
    return stored.select(*[c for c in _QUALIFIED_COLUMNS if c in stored.columns])


def _made_once(rows: DataFrame) -> DataFrame:
    """The same rows moved by branch key: a total sort reads its input twice, for the ranges and for the
    rows, and then reads what was moved instead of making it twice. Moved by a hash of the key: Spark leaves a move
    by the key out where the rows already lie by it."""
    return rows.repartition(F.xxhash64("cnpj"))


def outreach_legacy(qualified: DataFrame) -> DataFrame:
    """L1: the whole table by score and date, missing values first; ties by branch key, which also
    splits the range of a frequent score."""
    return _made_once(qualified).orderBy(
        F.col("digital_score").desc_nulls_first(), F.col("qualified_at").desc_nulls_first(), "cnpj"
    )


def outreach(qualified: DataFrame) -> DataFrame:
    """L2: outreach columns, best leads first, missing scores last, ties by branch key."""
    return _made_once(qualified.withColumn(
        "site_final_url", F.coalesce("site_final_url", "site_url")
    ).select(
        "cnpj", "razao_social", "nome_fantasia", "site_final_url", "presence_score",
        "commerce_score", "fit_score", "pain_score", "confidence_score", "lead_score",
        "presence_maturity", "commerce_maturity", "lead_classification", "contact_channel",
        "contact_value", "contact_confidence", "contact_role", "qualification_status",
        "rejection_reasons", "qualification_reasons", "decisor_nome", "uf", "municipio_descricao",
        "plataforma", "whatsapp_url", "instagram_url", "last_qualified_at", "updated_at",
    )).orderBy(
        F.col("lead_score").desc_nulls_last(), F.col("confidence_score").desc_nulls_last(), "cnpj"
    )


def qualified_list(qualified: DataFrame) -> DataFrame:
    """Qualified leads only; the filter comes before the sort. Made first, else the filter would hold a copy
    of all the rules that make the status, each of which names others."""
    return outreach(made_first(qualified).filter(F.col("qualification_status") == "qualified"))

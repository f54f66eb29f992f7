from itertools import product

import pytest

from fichario.functions import scoring as S
from fichario.operators import leads

STATE = {
    "cnpj": "string", "email_tipo": "string", "site_valid": "boolean", "site_reachable": "boolean",
    "whatsapp_valid": "boolean", "whatsapp_detected": "boolean", "instagram_url": "string",
    "linkedin_url": "string", "google_place_match_score": "int", "google_business_status": "string",
    "plataforma": "string", "plataforma_confianca": "int", "has_product_schema": "boolean",
    "has_product_page": "boolean", "has_price": "boolean", "has_add_to_cart": "boolean",
    "has_cart": "boolean", "has_checkout": "boolean", "has_catalog": "boolean", "has_chat": "boolean",
    "has_contact_form": "boolean", "coming_soon": "boolean", "cnpj_on_site": "boolean",
    "telefone_match": "boolean", "domain_is_shared": "boolean", "site_match_status": "string",
    "site_validation_reasons": "array<string>", "cnae_fiscal_principal": "string", "porte": "string",
    "opcao_mei": "string",
}


def score(spark, rules=None, **given):
    schema = ", ".join(f"{n} {t}" for n, t in STATE.items())
    frame = spark.createDataFrame([tuple(given.get(n) for n in STATE)], schema)
    return leads.score_leads(frame, **(rules or {})).first()


SHOP = dict(plataforma="shopify", plataforma_confianca=95, has_product_schema=True, has_price=True,
            has_add_to_cart=True, has_cart=True)


def test_all_unknown_is_zero(spark):
    row = score(spark)
    assert [row[c] for c in ("presence_score", "commerce_score", "fit_score", "pain_score",
                             "confidence_score", "lead_score")] == [0] * 6
    assert (row.presence_maturity, row.commerce_maturity, row.lead_classification) == (
        "offline", "sem_ecommerce", "lead_frio")


def test_strong_shop_is_confirmed(spark):
    row = score(spark, **SHOP)
    assert row.commerce_score == 75 and row.commerce_maturity == "ecommerce_confirmado"
    assert score(spark, coming_soon=True, **SHOP).commerce_score == 25


@pytest.mark.parametrize(
    "given, maturity",
    [
        (dict(plataforma="woocommerce", plataforma_confianca=75), "sem_ecommerce"),
        (dict(plataforma="woocommerce", plataforma_confianca=95, site_valid=True), "ecommerce_indicio"),
        (dict(site_valid=True, instagram_url="x", email_tipo="corporativo"), "sem_ecommerce"),
        (dict(has_product_schema=True, has_product_page=True, has_price=True), "ecommerce_provavel"),
    ],
)
def test_weak_signals_do_not_confirm(spark, given, maturity):
    assert score(spark, **given).commerce_maturity == maturity


def test_presence(spark):
    row = score(spark, site_valid=True, email_tipo="corporativo", instagram_url="i", whatsapp_valid=True,
                linkedin_url="l", google_place_match_score=70, google_business_status="OPERATIONAL")
    assert (row.presence_score, row.presence_maturity) == (100, "presenca_multicanal")
    assert score(spark, site_reachable=True, whatsapp_detected=True).presence_score == 13


def test_fit(spark):
    base = dict(cnae_fiscal_principal="4781400", porte="05", has_catalog=True, opcao_mei="S")
    assert score(spark, **base).fit_score == 40
    assert score(spark, dict(priority_cnaes=("4781400",), mei_penalty=15), **base).fit_score == 45


def test_pain_needs_no_chat(spark):
    given = dict(whatsapp_valid=True, site_valid=True, has_contact_form=True, **SHOP)
    assert score(spark, **given).pain_score == 75
    assert score(spark, has_chat=True, **given).pain_score == 0


def test_confidence(spark):
    assert score(spark, site_match_status="rejected_webmail", site_valid=True).confidence_score == 0
    assert score(spark, site_valid=True, whatsapp_valid=True, cnpj_on_site=True,
                 domain_is_shared=True).confidence_score == 60
    assert score(spark, site_valid=True, whatsapp_valid=True,
                 site_validation_reasons=["title_incompativel:dominio"]).confidence_score == 0


def test_lead_rounds_half_to_even(spark):
    grid = [(f, p, c) for f, p, c in product(range(0, 101, 5), range(0, 101, 10), range(0, 101, 6))]
    frame = spark.createDataFrame(grid, "fit_score int, pain_score int, confidence_score int")
    for row in frame.withColumn("lead", S.lead_score()).collect():
        assert row.lead == round(row[0] * 0.40 + row[1] * 0.35 + row[2] * 0.25), row
    assert (80, 60, 40) and round(80 * 0.4 + 60 * 0.35 + 40 * 0.25) == 63


ROW = dict(
    cnpj="1", lead_score=75, confidence_score=70, digital_score=0, commerce_maturity="ecommerce_confirmado",
    digital_maturity=None, site_valid=True, site_reachable=True, site_match_status="validated",
    site_validation_reasons=[], decisor_nome="Maria Silva", telefone_1="11999998888",
    email="contato@loja.com.br", email_original=None, email_tipo="corporativo", whatsapp_valid=True,
    whatsapp_number_normalized="5511999998888", whatsapp_url="https://wa.me/5511999998888",
    instagram_url=None, telefone_candidato_whatsapp=None,
)
ROW_SCHEMA = (
    "cnpj string, lead_score int, confidence_score int, digital_score int, commerce_maturity string,"
    " digital_maturity string, site_valid boolean, site_reachable boolean, site_match_status string,"
    " site_validation_reasons array<string>, decisor_nome string, telefone_1 string, email string,"
    " email_original string, email_tipo string, whatsapp_valid boolean,"
    " whatsapp_number_normalized string, whatsapp_url string, instagram_url string,"
    " telefone_candidato_whatsapp string"
)
NO_CHANNEL = dict(whatsapp_valid=False, whatsapp_url=None, whatsapp_number_normalized=None,
                  telefone_1="", email="", email_tipo="gratuito")


@pytest.mark.parametrize(
    "given, minimum, status, against",
    [
        ({}, 60, "qualified", []),
        (dict(decisor_nome=""), 60, "qualified", []),
        (dict(instagram_url="https://instagram.com/l", **NO_CHANNEL), 60, "rejected",
         ["sem_canal_outreach_valido", "instagram_nao_automatico"]),
        (dict(confidence_score=50), 80, "rejected", ["confidence_baixa:50<80"]),
        (dict(confidence_score=0, digital_score=65), 60, "qualified", []),
        (dict(lead_score=None, digital_score=10), 60, "rejected", ["lead_baixo:10<60"]),
        (dict(site_match_status="rejected_webmail"), 60, "blocked", ["site_webmail"]),
        (dict(site_validation_reasons=["title_incompativel:dominio"]), 60, "review_required",
         ["site_incompativel_cnae"]),
        (dict(site_valid=False, commerce_maturity="sem_ecommerce"), 60, "review_required",
         ["site_nao_validado"]),
        (dict(telefone_candidato_whatsapp="w", **NO_CHANNEL), 60, "rejected", ["sem_canal_outreach_valido"]),
    ],
)
def test_qualification(spark, given, minimum, status, against):
    frame = spark.createDataFrame([tuple({**ROW, **given}.values())], ROW_SCHEMA)
    row = leads.evaluate_qualification(leads.with_channel(frame), min_confidence=minimum).first()
    assert (row.qualification_status, row.rejection_reasons) == (status, against)
    if status == "qualified":
        assert "email_corporativo" in row.qualification_reasons
        assert ("decisor_cadastral" in row.qualification_reasons) == bool({**ROW, **given}["decisor_nome"])


@pytest.mark.parametrize(
    "given, status",
    [
        (dict(has_html=True, site_reachable=True, site_valid=True, has_checkout=True, site_url="u"), "done"),
        (dict(has_html=True, site_reachable=True, site_valid=False, has_checkout=True, site_url="u"), "partial"),
        (dict(site_url=None), "no_site"), (dict(site_url="u", site_reachable=False), "failed"),
        (dict(site_url="u", site_reachable=True), "partial"),
    ],
)
def test_enrich_status(spark, given, status):
    names = ("has_html", "site_reachable", "site_valid", "has_checkout", "has_cart", "has_add_to_cart",
             "has_product_schema", "has_price")
    schema = ", ".join(f"{n} boolean" for n in names) + ", plataforma string, site_url string"
    row = tuple(given.get(n) for n in (*names, "plataforma", "site_url"))
    assert leads.enrich_status(spark.createDataFrame([row], schema)).first().enrich_status == status

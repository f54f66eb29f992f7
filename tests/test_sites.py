from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from fichario.operators import sites
from fichario.operators.pages import page_content, page_signals
from fichario.plans import enrich

COMPANY = dict(
    cnpj="12345678000190", nome_fantasia="Loja Azul", razao_social="Loja Azul Ltda",
    municipio_descricao="São Paulo", uf="SP", telefone_1="11999998888", email_tipo="corporativo",
    email_dominio="loja.com.br", domain_shared_count=0, site_url=None, site_source=None,
)


def company(spark, **given):
    row = {**COMPANY, **given}
    schema = ", ".join(f"{n} {'bigint' if n == 'domain_shared_count' else 'string'}" for n in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def ownership(spark, html, url="https://www.loja.com.br/", **given):
    page = spark.createDataFrame([(url, html)], "url string, html string")
    facts = page_signals(page_content(page)).select("host", "site_titulo", "content", "content_digits")
    rows = sites.match_names(company(spark, **given)).join(facts)
    return sites.site_ownership(rows).first()


def test_full_evidence(spark):
    row = ownership(spark, "<p>LOJA AZUL</p> Sao Paulo SP (11) 99999-8888 CNPJ 12.345.678/0001-90")
    assert (row.site_match_score, row.site_match_status, row.site_valid, row.cnpj_on_site) == (
        100, "validated", True, True)


@pytest.mark.parametrize(
    "html, given, score, reasons",
    [
        ("Login required", {}, 15, ["dominio_email_coincide"]),
        ("Loja Azul", dict(domain_shared_count=4), 15,
         ["nome_fantasia_no_conteudo", "dominio_email_coincide", "dominio_compartilhado"]),
        ("Loja Azul", dict(domain_shared_count=1), 35,
         ["nome_fantasia_no_conteudo", "dominio_email_coincide", "dominio_possivelmente_compartilhado"]),
        ("loja azul", dict(nome_fantasia=None, email_dominio="b.com"), 20, ["razao_social_no_conteudo"]),
        ("<title>Contabilidade Silva</title>", {}, 0,
         ["title_incompativel:contabil", "title_incompativel:contabilidade", "dominio_email_coincide"]),
        ("<title>registro.br</title>", {}, 0, ["title_incompativel:registro.br", "dominio_email_coincide"]),
        ("spray", dict(cnpj=""), 15, ["dominio_email_coincide"]),
    ],
)
def test_partial_evidence(spark, html, given, score, reasons):
    row = ownership(spark, html, **given)
    assert (row.site_match_score, row.site_validation_reasons) == (score, reasons)
    assert not row.site_valid


@pytest.mark.parametrize(
    "url, given, status",
    [
        ("https://loja.com.br/", dict(email_tipo="gratuito"), "rejected_webmail"),
        ("https://www.gmail.com/", {}, "rejected_webmail"),
        ("https://m.facebook.com/l", {}, "redirect_social"),
        ("https://foox.com/", {}, "unverified"),
    ],
)
def test_early_exits(spark, url, given, status):
    row = ownership(spark, "<p>nada</p>", url=url, **given)
    assert (row.site_match_status, row.site_match_score) == (status, 0)


@pytest.mark.parametrize(
    "given, urls",
    [
        ({}, ["https://loja.com.br/", "https://www.loja.com.br/"]),
        (dict(site_url="http://x.com", site_source="google_places"),
         ["http://x.com", "https://loja.com.br/", "https://www.loja.com.br/"]),
        (dict(email_dominio="gmail.com", email_tipo="gratuito"), []),
        (dict(email_dominio="yahoo.com.br"), []), (dict(email_dominio=None), []),
    ],
)
def test_site_candidates(spark, given, urls):
    rows = sites.site_candidates(company(spark, **given)).orderBy("attempt").collect()
    assert [r.candidate_url for r in rows] == urls


def test_url_key(apply):
    given = ["HTTPS://Loja.com.br", "http://loja.com.br/#x", "//u:p@Loja.com.br/?a=1"]
    assert apply(sites.url_key, given) == ["loja.com.br/", "loja.com.br/", "loja.com.br/?a=1"]


ATTEMPT = "cnpj string, attempt int, status int, site_valid boolean, site_match_status string"


@pytest.mark.parametrize(
    "rows, chosen",
    [
        ([(0, None, None, None), (1, 200, False, "unverified"), (2, 200, True, "validated")], 2),
        ([(0, 404, None, None), (1, 200, True, "validated")], 0),
        ([(0, 200, False, "rejected_webmail"), (1, 200, True, "validated")], 0),
        ([(0, 403, None, None), (1, 500, None, None), (2, None, None, None)], 1),
        ([(0, None, None, None)], None),
    ],
)
def test_best_attempt(spark, rows, chosen):
    frame = spark.createDataFrame([("1", *r) for r in rows], ATTEMPT)
    got = sites.best_attempts(frame, ["status"]).collect()
    assert [r.attempt for r in got] == ([] if chosen is None else [chosen])


PLACE = "cnpj string, position int, place_id string, display_name string, formatted_address string," \
    " national_phone string, website string, business_status string"


def place_companies(spark):
    return spark.createDataFrame(
        [("1", "Moda Center", "Moda Center LTDA", "Curitiba", "PR", "41999999999", "Rua A", "80000-000")],
        "cnpj string, nome_fantasia string, razao_social string, municipio_descricao string, uf string,"
        " telefone_1 string, logradouro string, cep string",
    )


def test_places(spark):
    rows = [
        ("1", 0, "a", "Loja Moda Center", "Rua A, São Paulo - SP", None, "w", "OPERATIONAL"),
        ("1", 1, "b", "Loja Moda Center", "Rua A, Curitiba - PR, 80000", None, "w", "OPERATIONAL"),
        ("1", 2, "c", "Moda Center", "Rua A, Curitiba - PR, 80000-000", "(41) 99999-9999", "w", "OPERATIONAL"),
        ("1", 3, "d", "Moda Center", "Rua A, Curitiba - PR, 80000-000", "(41) 99999-9999", "v", "CLOSED"),
    ]
    scored = sites.place_scores(spark.createDataFrame(rows, PLACE), place_companies(spark))
    assert {r.place_id: r.match_score for r in scored.collect()} == {"a": 0, "b": 60, "c": 85, "d": 85}
    best = sites.best_places(scored).first()
    assert (best.place_id, best.google_place_match_score, best.website) == ("c", 85, "w")
    assert sites.best_places(scored, floor=90).first().place_id is None


def test_similarity_matches_brute_force(spark):
    names = ["loja moda", "moda loja", "", "casa cia", "padaria sao joao 3", "padaria sao joao", "abc", "xyz",
             "abcd", None]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    got = pairs.select("a", "b", sites.name_similarity(F.col("a"), F.col("b"), 0.75).alias("r"))
    for row in got.collect():
        known = row.a is not None and row.b is not None
        exact = SequenceMatcher(None, row.a, row.b).ratio() if known else 0.0
        assert (row.r >= 0.75) == (exact >= 0.75), row
        assert row.r in (0.0, exact)


def test_provider_overlay(spark):
    rows = spark.createDataFrame(
        [("1", None, None, None), ("2", "http://own", "google_places", "Ana"), ("3", None, None, "")],
        "cnpj string, site_url string, site_source string, decisor_nome string",
    )
    records = spark.createDataFrame(
        [("1", "http://p", "", "R$ 2", "Bia"), ("2", "http://p", "R$ 1", "R$ 2", "Bia")],
        "cnpj string, website string, faixa_faturamento_empresa string, faixa_faturamento_cnpj string,"
        " administrador string",
    )
    got = {r.cnpj: r for r in sites.overlay_provider(rows, records).collect()}
    assert (got["1"].site_url, got["1"].site_source, got["1"].decisor_nome) == (
        "http://p", "external_provider", "Bia")
    assert (got["2"].site_url, got["2"].decisor_nome, got["2"].faturamento_estimado) == (
        "http://own", "Ana", "R$ 1")
    assert (got["3"].site_url, got["3"].faturamento_estimado_fonte) == (None, None)


def test_decide_keeps_what_earlier_attempts_left(spark):
    """A later failing attempt decides the status, the match of the earlier page stays."""
    pages = spark.createDataFrame(
        [
            ("https://loja.com.br/", 200, "text/html", None, None, 0, "<p>Loja Azul</p>"),
            ("https://www.loja.com.br/", 503, "text/html", None, None, 0, None),
        ],
        "url string, status int, content_type string, error string, retry_after string,"
        " redirect_count int, html string",
    )
    attempts = enrich.match_sites(company(spark), enrich.analyze_pages(pages))
    row = enrich.decide_sites(attempts).first()
    assert (row.status, row.site_match_score, row.site_match_status) == (503, 45, "partial_match")
    assert (row.fetch_error, row.retry_after_hours) == ("http_503", 24)


def test_a_url_fetched_often_counts_once(spark):
    """The latest fetch decides; without times the best answer does; the scheme makes no difference."""
    schema = ("url string, status int, content_type string, error string, retry_after string,"
              " redirect_count int, html string, fetched_at timestamp")
    page = "<p>Loja Azul</p>"
    rows = [
        ("https://loja.com.br/", 503, "text/html", None, None, 0, None, "2024-01-01 00:00:00"),
        ("http://loja.com.br/", 200, "text/html", None, None, 0, page, "2024-01-02 00:00:00"),
        ("https://loja.com.br/", 200, "text/html", None, None, 0, "<p>old</p>", "2023-01-02 00:00:00"),
    ]
    log = spark.createDataFrame(rows, schema.replace("fetched_at timestamp", "t string")).withColumn(
        "fetched_at", F.col("t").cast("timestamp")).drop("t")
    facts = enrich.analyze_pages(log)
    attempts = enrich.match_sites(company(spark), facts)
    assert attempts.groupBy("cnpj", "attempt").count().filter("count > 1").count() == 0
    assert enrich.decide_sites(attempts).first().site_match_score == 45
    undated = enrich.analyze_pages(log.drop("fetched_at").filter("status = 503 or html = '<p>Loja Azul</p>'"))
    assert enrich.decide_sites(enrich.match_sites(company(spark), undated)).first().status == 200


@pytest.mark.parametrize("order", ["page_id", "-page_id"])
def test_fetches_alike_in_all_else_go_by_number(spark, order):
    """Two fetches of a URL at one moment with one answer: the same one counts however the rows come."""
    rows = [(f"k{k}", sign * (k + 1), f"https://k{k}/", 404, "") for k in range(50) for sign in (1, -1)]
    log = spark.createDataFrame(rows, "url_key string, page_id long, url string, status int, content string")
    log = log.withColumn("fetched_at", F.timestamp_seconds(F.lit(0))).orderBy(F.expr(order))
    assert sorted(r.page_id for r in sites.latest_fetches(log).collect()) == list(range(-50, 0))


def test_any_number_of_attempts_counts(spark):
    rows = [("1", n, 500, False, None, f"http_{n}", False) for n in range(7)] + [("1", 7, 200, True, "validated", None, True)]
    rows += [("1", 8, 404, False, None, "http_404", False)]
    attempts = spark.createDataFrame(
        rows, "cnpj string, attempt int, status int, site_valid boolean, site_match_status string,"
        " fetch_error string, cnpj_on_site boolean")
    empty = company(spark).limit(0)
    full = enrich.match_sites(empty, enrich.analyze_pages(spark.createDataFrame(
        [], "url string, status int, content_type string, error string, retry_after string, redirect_count int, html string")))
    row = enrich.decide_sites(full.unionByName(attempts, allowMissingColumns=True)).first()
    assert (row.status, row.site_match_status, row.fetch_error, row.cnpj_on_site) == (200, "validated", "http_6", True)

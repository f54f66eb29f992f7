"""Registry-shaped inputs derived from the given tables.

Each input is one SQL projection that both Spark and the checking database understand, so both
sides start from the same raw text rows. Everything after that - cleaning, typing, joining - is
DataFrame code here and independent SQL in ``oracle``.

The projections keep every row of their source table. Variety (blank names, free e-mail, broken
dates and so on) is spread over the rows by key arithmetic; where one side of a join must lack rows of
the other, the keys of some rows are moved out of the range of all others.
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions.text import clean_text
from fichario.operators import by_root
from fichario.operators.by_root import ByRoot
from fichario.operators.clean import clean_rows
from fichario.operators.views import (
    Tables, complete_companies, prospect_candidates, stored_companies)
from fichario.plans.enrich import analyze_pages
from fichario.schemas import DATASETS
from fichario.session import new_folder, settled, stored_bytes

COMPETENCE = "2026-07"
YEAR = 2024
NOW = "1999-06-15 12:00:00"


def text(expr: str) -> str:
    return f"CAST({expr} AS string)"


def whole(expr: str) -> str:
    return f"CAST(floor({expr}) AS bigint)"


def pad(expr: str, n: int) -> str:
    """Zero-padded text that never cuts longer numbers."""
    t = text(expr)
    return f"CASE WHEN length({t}) < {n} THEN lpad({t}, {n}, '0') ELSE {t} END"


def packed(values, index: str) -> str:
    """Value of a list of equally long texts by index expression."""
    width = len(values[0])
    return f"substr('{''.join(values)}', CAST(1 + {width} * ({index}) AS int), {width})"


def date_text(expr: str) -> str:
    return f"replace(substr({text(expr)}, 1, 10), '-', '')"


_ACTIVITY = [*K.RETAIL_CNAES, "6201501", "8599604", "4711302", "5611201", "9602501", "6920601"]
_STATES = ["SP", "PR", "MG", "RJ", "RS"]
_SUFFIX = pad("o_orderkey", 6)
ROOT = pad("o_custkey", 8)
BRANCH = f"({ROOT}) || ({_SUFFIX})"
_GROUP = whole("o_orderkey / 10")


def moved(condition: str, key: str) -> str:
    """A zero-padded key, moved out of the range of all others where the condition holds."""
    return f"CASE WHEN {condition} THEN '9' || substr({key}, 2) ELSE {key} END"


STATE_KEY = moved("o_orderpriority = '5-LOW'", BRANCH)
PARTNER_ROOT = pad("l_partkey", 8)
PROVIDER_KEY = moved("o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", BRANCH)


TRADE_NAME = f"""CASE CAST(o_orderkey % 8 AS int)
      WHEN 0 THEN '' WHEN 1 THEN '   '
      WHEN 2 THEN 'Loja Central ' || {text(f'{_GROUP} % 600')}
      WHEN 3 THEN ' Padaria São João ' || {text('o_orderkey % 60')} || ' '
      ELSE 'Comércio ' || {text('o_orderkey')} || ' Ltda' END"""
AREA = packed(["11", "41", "55", "21", "20"], "o_orderkey % 5")
PHONE = f"""CASE CAST(o_orderkey % 9 AS int)
      WHEN 0 THEN '' WHEN 1 THEN '00000000' WHEN 2 THEN '3333-' || {pad('o_orderkey % 10000', 4)}
      ELSE '9' || {pad('(o_orderkey * 7919) % 100000000', 8)} END"""
CITY = pad("o_custkey % 25", 4)
STATE = packed(_STATES, "(o_custkey % 25) % 5")
_EMAIL = f"""CASE CAST(o_orderkey % 10 AS int)
      WHEN 0 THEN 'contato@loja' || {text(f'{_GROUP} % 600')} || '.com.br'
      WHEN 1 THEN 'Loja' || {text('o_orderkey')} || '@gmail.com'
      WHEN 2 THEN 'FISCAL@Loja' || {text(f'{_GROUP} % 600')} || '.com.br'
      WHEN 3 THEN ' suporte@loja' || {text(f'{_GROUP} % 600')} || '.com.br' || chr(160)
      WHEN 4 THEN 'maria.silva@empresa' || {text('o_orderkey')} || '.com.br'
      WHEN 5 THEN ''
      WHEN 6 THEN 'sem-arroba'
      WHEN 7 THEN 'vendas@loja' || {text('o_custkey')} || '.com.br'
      WHEN 8 THEN 'joao@hotmail.com'
      ELSE 'rh-equipe@contabil' || {text('o_orderkey % 7')} || '.com.br' END"""

_CENTS = f"({whole('round(abs(c_acctbal) * 100)')} * 2000)"
_REAIS = whole(f"{_CENTS} / 100")

RAW: dict[str, str] = {
    "raw_empresas": f"""
    SELECT {pad('c_custkey', 8)} AS cnpj_basico,
      CASE CAST(c_custkey % 6 AS int)
        WHEN 0 THEN '  ' || c_name || ' LTDA'
        WHEN 1 THEN c_name || ' Comércio S.A.' || chr(160)
        WHEN 2 THEN 'Padaria "' || c_name || '" ME'
        WHEN 3 THEN c_name || chr(10) || 'Filial; Centro'
        WHEN 4 THEN chr(9) || 'São ' || c_name || ' EIRELI'
        ELSE c_name END AS razao_social,
      {pad('c_nationkey', 4)} AS natureza_juridica,
      {packed(['05', '16', '49', '10'], 'c_custkey % 4')} AS qualificacao_responsavel,
      CASE CAST(c_custkey % 7 AS int)
        WHEN 0 THEN '' WHEN 1 THEN 'abc'
        WHEN 2 THEN {text(whole(f'{_REAIS} / 1000'))} || '.' || ({pad(f'{_REAIS} % 1000', 3)}) || ',' || ({pad(f'{_CENTS} % 100', 2)})
        ELSE {text(_REAIS)} || ',' || ({pad(f'{_CENTS} % 100', 2)}) END AS capital_social,
      CASE CAST(c_custkey % 4 AS int) WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '05'
        ELSE '' END AS porte,
      '' AS ente_federativo_responsavel
    FROM {{customer}}""",
    "raw_estabelecimentos": f"""
    SELECT {ROOT} AS cnpj_basico,
      substr({_SUFFIX}, 1, CAST(length({_SUFFIX}) - 2 AS int)) AS cnpj_ordem,
      substr({_SUFFIX}, CAST(length({_SUFFIX}) - 1 AS int), 2) AS cnpj_dv,
      CASE WHEN o_orderkey % 4 = 0 THEN '1' ELSE '2' END AS identificador_matriz_filial,
      {TRADE_NAME} AS nome_fantasia,
      CASE WHEN o_orderstatus = 'F' THEN '08' WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 1
        THEN '04' ELSE '02' END AS situacao_cadastral,
      CASE CAST(o_orderkey % 6 AS int) WHEN 0 THEN '00000000' WHEN 1 THEN '' WHEN 2 THEN '20231301'
        WHEN 3 THEN '2024131' ELSE {date_text('o_orderdate')} END AS data_situacao_cadastral,
      {packed(['00', '01', '21'], 'o_orderkey % 3')} AS motivo_situacao_cadastral,
      '' AS nome_cidade_exterior, '105' AS pais,
      CASE WHEN o_orderkey % 50 = 7 THEN '0' ELSE {date_text('o_orderdate')} END
        AS data_inicio_atividade,
      CASE WHEN o_orderkey % 24 = 23 THEN '111301' ELSE {packed(_ACTIVITY, 'o_orderkey % 24')} END
        AS cnae_fiscal_principal,
      CASE CAST(o_orderkey % 5 AS int) WHEN 0 THEN '' WHEN 1 THEN '1111111, 4781400'
        WHEN 2 THEN '111301,111301,62' WHEN 3 THEN {packed(_ACTIVITY, '(o_orderkey + 5) % 24')}
        ELSE '47512010,abcdefg' END AS cnaes_fiscais_secundarios,
      'RUA' AS tipo_logradouro,
      'Rua ' || o_orderpriority AS logradouro,
      {text('o_orderkey % 900')} AS numero, '' AS complemento, 'Centro' AS bairro,
      {pad('(o_orderkey * 37) % 100000000', 8)} AS cep,
      CASE WHEN o_orderkey % 31 = 0 THEN lower({STATE}) ELSE {STATE} END AS uf,
      CASE WHEN o_orderkey % 29 = 0 THEN {text('o_custkey % 25')} ELSE {CITY} END AS municipio,
      CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE {AREA} END AS ddd1,
      {PHONE} AS telefone1,
      CASE WHEN o_orderkey % 3 = 0 THEN '11' ELSE '' END AS ddd2,
      CASE WHEN o_orderkey % 3 = 0 THEN '33334444' ELSE '' END AS telefone2,
      '' AS ddd_fax, '' AS fax,
      {_EMAIL} AS correio_eletronico,
      '' AS situacao_especial, '' AS data_situacao_especial
    FROM {{orders}}""",
    "raw_socios": f"""
    SELECT {pad('l_partkey', 8)} AS cnpj_basico,
      {packed(['1', '2', '3'], 'l_linenumber % 3')} AS identificador_socio,
      ' Sócio ' || {text('l_suppkey')} || ' ' || l_returnflag AS nome_socio_razao_social,
      '***' || {pad('l_suppkey', 6)} || '**' AS cpf_cnpj_socio,
      {packed(['05', '16', '49', '22', '10'], 'l_linenumber % 5')} AS qualificacao_socio,
      CASE WHEN l_linenumber = 7 THEN '' ELSE {date_text('l_shipdate')} END
        AS data_entrada_sociedade,
      '' AS pais, '' AS representante_legal, '' AS nome_representante,
      '00' AS qualificacao_representante,
      {text('l_linenumber')} AS faixa_etaria
    FROM {{lineitem}}""",
    "raw_simples": f"""
    SELECT {pad("CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey + 90000000 ELSE c_custkey END", 8)}
        AS cnpj_basico,
      CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS opcao_simples,
      '20200101' AS data_opcao_simples, '00000000' AS data_exclusao_simples,
      CASE WHEN c_custkey % 5 = 0 THEN 'S' ELSE 'N' END AS opcao_mei,
      CASE WHEN c_custkey % 5 = 0 THEN '20210630' ELSE '' END AS data_opcao_mei,
      '' AS data_exclusao_mei
    FROM {{customer}}""",
    "raw_cnaes": f"""
    SELECT {packed([*_ACTIVITY, '0111301'], 'n_nationkey % 25')} AS codigo,
      'Atividade ' || n_name AS descricao FROM {{nation}}""",
    "raw_municipios": f"""
    SELECT {pad('n_nationkey', 4)} AS codigo, 'São ' || n_name AS descricao FROM {{nation}}""",
    "raw_naturezas": f"""
    SELECT {pad('CASE WHEN n_nationkey = 13 THEN 9013 ELSE n_nationkey END', 4)} AS codigo,
      ' Natureza ' || n_name || ' ' AS descricao
    FROM {{nation}}""",
    "population": f"""
    SELECT {text('1100000 + n_nationkey')} AS codigo_ibge,
      {packed(_STATES, 'n_nationkey % 5')} AS uf, {pad('n_nationkey', 4)} AS codigo,
      'São ' || n_name AS nome, CAST(13000 * (n_nationkey + 1) AS int) AS populacao,
      CAST({YEAR} AS int) AS ano_referencia
    FROM {{nation}}""",
    # One listing row per part: file names of all kinds, some unknown or not zipped.
    "listing": f"""
    SELECT '20' || {pad('p_size % 30', 2)} || '-' || ({pad('p_partkey % 14', 2)}) AS competence,
      CASE CAST(p_partkey % 12 AS int) WHEN 0 THEN 'Empresas' WHEN 1 THEN 'ESTABELECIMENTOS'
        WHEN 2 THEN 'socios' WHEN 3 THEN 'Simples' WHEN 4 THEN 'Cnaes' WHEN 5 THEN 'F.Municipios'
        WHEN 6 THEN 'Paises' WHEN 7 THEN 'Naturezas' WHEN 8 THEN 'Qualificacoes'
        WHEN 9 THEN 'Motivos' WHEN 10 THEN 'SociosSimples' ELSE 'Leiame' END
        || {text('p_partkey')}
        || CASE WHEN p_partkey % 5 = 0 THEN '.ZIP' WHEN p_partkey % 17 = 1 THEN '.csv'
           ELSE '.zip' END AS name,
      CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size * 1000 AS bigint) END AS size,
      CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS last_modified
    FROM {{part}}""",
    # What is stored about the enrichment of most branches.
    "state": f"""
    SELECT {STATE_KEY} AS cnpj,
      {moved("o_orderpriority = '5-LOW'", ROOT)} AS cnpj_basico,
      CASE CAST(o_orderkey % 6 AS int) WHEN 0 THEN 'done' WHEN 1 THEN 'partial'
        WHEN 2 THEN 'no_site' WHEN 3 THEN 'failed' WHEN 4 THEN 'done' ELSE 'pending' END
        AS enrich_status,
      CASE CAST(o_orderkey % 5 AS int) WHEN 0 THEN 'v1' WHEN 1 THEN NULL ELSE 'v2' END
        AS enrichment_version,
      CASE CAST(o_orderkey % 7 AS int) WHEN 0 THEN 'v1' WHEN 1 THEN NULL ELSE 'v2' END
        AS score_version,
      CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS next_retry_at,
      CASE WHEN o_orderkey % 19 = 0 THEN 'google_places_no_result' ELSE NULL END AS retry_reason,
      CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey ELSE NULL END AS processing_run_id,
      CASE WHEN o_orderkey % 26 = 0 THEN NULL ELSE o_orderdate END AS processing_started_at,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS int) END
        AS enrich_attempts,
      CASE WHEN o_orderkey % 3 = 1 THEN 'place-' || {text('o_orderkey')} ELSE NULL END
        AS google_place_id,
      CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate END AS google_places_checked_at,
      o_orderdate AS enriched_at,
      CAST((o_orderkey * 13) % 101 AS int) AS digital_score,
      CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE CAST((o_orderkey * 31) % 101 AS int) END
        AS confidence_score,
      CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST((o_orderkey * 17) % 101 AS int) END
        AS lead_score,
      CASE CAST(o_orderkey % 6 AS int) WHEN 0 THEN 'ecommerce_confirmado'
        WHEN 1 THEN 'ecommerce_provavel' WHEN 2 THEN 'ecommerce_indicio' WHEN 3 THEN NULL
        ELSE 'sem_ecommerce' END AS commerce_maturity,
      CASE WHEN o_orderkey % 5 = 0 THEN 'presenca_ativa' WHEN o_orderkey % 5 = 1 THEN NULL
        ELSE 'offline' END AS presence_maturity,
      CASE WHEN o_orderkey % 4 = 0 THEN 'lead_quente' WHEN o_orderkey % 4 = 1 THEN NULL
        ELSE 'lead_frio' END AS lead_classification,
      'sem_ecommerce' AS digital_maturity,
      CASE CAST(o_orderkey % 16 AS int) WHEN 0 THEN 'rejected_webmail' WHEN 1 THEN 'unverified'
        WHEN 2 THEN NULL WHEN 3 THEN 'partial_match' ELSE 'validated' END AS site_match_status,
      CASE CAST(o_orderkey % 11 AS int) WHEN 0 THEN 'title_incompativel:dominio|uf_no_conteudo'
        WHEN 1 THEN '' ELSE 'uf_no_conteudo' END AS reasons_text,
      o_orderkey % 2 = 0 AS site_valid, o_orderkey % 3 <> 1 AS site_reachable,
      o_orderkey % 5 <> 2 AS site_ativo,
      o_orderkey % 7 < 3 AS whatsapp_valid, o_orderkey % 7 < 5 AS whatsapp_detected,
      CASE WHEN o_orderkey % 7 < 3 THEN '55119' || ({pad('o_orderkey % 100000000', 8)})
        ELSE NULL END AS whatsapp_number_normalized,
      CASE WHEN o_orderkey % 7 < 2 THEN 'https://wa.me/55119' || ({pad('o_orderkey % 100000000', 8)})
        ELSE NULL END AS whatsapp_url,
      CASE WHEN o_orderkey % 4 = 1 THEN 'https://wa.me/5541988887777' ELSE NULL END
        AS telefone_candidato_whatsapp,
      CASE WHEN o_orderkey % 3 = 0 THEN 'https://instagram.com/l' || {text('o_orderkey')}
        ELSE NULL END AS instagram_url,
      CASE WHEN o_orderkey % 10 = 3 THEN 'https://linkedin.com/l' || {text('o_orderkey')}
        ELSE '' END AS linkedin_url,
      CASE CAST(o_orderkey % 4 AS int) WHEN 0 THEN 'gratuito' WHEN 1 THEN 'invalido'
        ELSE 'corporativo' END AS email_tipo,
      'contato@loja' || {text('o_orderkey % 600')} || '.com.br' AS email_original,
      'loja' || {text('o_orderkey % 600')} || '.com.br' AS email_dominio,
      CASE WHEN o_orderkey % 6 = 2 THEN NULL ELSE 'https://loja' || {text('o_orderkey % 600')}
        || '.com.br/' END AS site_url,
      CASE WHEN o_orderkey % 6 = 0 THEN 'https://www.loja' || {text('o_orderkey % 600')}
        || '.com.br/' ELSE NULL END AS site_final_url,
      CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE 200 END AS site_http_status,
      CASE WHEN o_orderkey % 23 < 14 THEN 'plataforma_' || {text('o_orderkey % 23')} ELSE NULL END
        AS plataforma,
      CASE WHEN o_orderkey % 23 < 14 THEN CAST(45 + 15 * (o_orderkey % 4) AS int) ELSE 0 END
        AS plataforma_confianca,
      CAST((o_orderkey * 3) % 101 AS int) AS google_place_match_score,
      CASE WHEN o_orderkey % 3 = 0 THEN 'OPERATIONAL' WHEN o_orderkey % 3 = 1 THEN 'CLOSED'
        ELSE NULL END AS google_business_status,
      o_orderkey % 3 = 1 AS has_product_page, o_orderkey % 4 = 2 AS has_product_schema,
      o_orderkey % 5 < 2 AS has_price, o_orderkey % 6 < 3 AS has_cart,
      o_orderkey % 7 = 4 AS has_checkout, o_orderkey % 8 < 4 AS has_add_to_cart,
      o_orderkey % 9 < 4 AS has_catalog, o_orderkey % 10 < 4 AS has_contact_form,
      o_orderkey % 11 < 4 AS has_chat, o_orderkey % 12 = 5 AS coming_soon,
      o_orderkey % 13 < 3 AS cnpj_on_site, o_orderkey % 14 < 4 AS domain_is_shared,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Pessoa ' || {text('o_custkey')} END
        AS decisor_nome,
      CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'faixa ' || {text('o_orderkey % 4')} END
        AS faixa_porte_receita,
      'faixa antiga' AS faixa_faturamento_estimada, 'heuristica_local' AS faturamento_fonte,
      CASE WHEN o_custkey % 4 = 0 THEN '01' WHEN o_custkey % 4 = 1 THEN '03'
        WHEN o_custkey % 4 = 2 THEN '05' ELSE NULL END AS porte,
      CASE WHEN o_custkey % 5 = 0 THEN 'S' ELSE 'N' END AS opcao_mei,
      CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {packed(_ACTIVITY, 'o_orderkey % 24')} END
        AS cnae_fiscal_principal
    FROM {{orders}}""",
    # Crawled pages: one site per 14 page ids (landing page and inner paths), with shop snippets
    # and the details of the branch that owns the site.
    "site_pages": f"""
    SELECT p.page_id AS page_id, p.site AS site,
      CASE WHEN p.site % 5 = 1 THEN 'http' ELSE 'https' END || '://'
        || CASE WHEN p.site % 3 = 0 THEN 'www.' ELSE '' END
        || 'loja' || {text('p.site')} || '.com.br'
        || CASE CAST(p.page_id % 14 AS int) WHEN 0 THEN '/'
           {' '.join(f"WHEN {i} THEN '{path}'" for i, path in enumerate(K.INNER_PATHS, 1))} END
        AS url,
      CASE CAST(p.page_id % 17 AS int) WHEN 3 THEN 404 WHEN 5 THEN 500 WHEN 7 THEN 403
        WHEN 9 THEN 429 WHEN 11 THEN NULL WHEN 13 THEN NULL WHEN 14 THEN 302 ELSE 200 END
        AS status,
      CASE WHEN p.page_id % 17 = 15 THEN 'application/json'
        WHEN p.page_id % 2 = 0 THEN 'Text/HTML; charset=utf-8' ELSE 'application/xhtml+xml' END
        AS content_type,
      CASE CAST(p.page_id % 17 AS int) WHEN 11 THEN 'dns_falhou' WHEN 13 THEN 'ConnectionError'
        WHEN 14 THEN 'redirect_sem_location' ELSE NULL END AS error,
      CASE WHEN p.page_id % 17 <> 9 THEN NULL WHEN p.page_id % 2 = 0 THEN '12' ELSE 'soon' END
        AS retry_after,
      CAST(p.page_id % 3 AS int) AS redirect_count,
      replace(p.html, '</article>',
        CASE CAST((p.page_id * 5 + p.site) % 12 AS int)
        WHEN 0 THEN '<script src="https://CDN.shopify.com/s.js"></script><i class="shopify-section"></i><a href="/cart">x</a><b>Adicionar ao carrinho</b>'
        WHEN 1 THEN '<a href="https://wa.me/5511999998888?text=oi">w</a><a href="https://www.Instagram.com/loja?igsh=1">i</a>'
        WHEN 2 THEN '<script>__vtex;vteximg;vtexassets</script><a href="/checkout">c</a><div class="box product">Por R$ 10</div>'
        WHEN 3 THEN '<a href="https://api.whatsapp.com/send?phone=%2B55%2011%2098888-7777&text=oi">w</a><a href="//linkedin.com/company/x?y=1">l</a><script src="https://code.tawk.to/1"></script>'
        WHEN 4 THEN '<script type="application/ld+json">{{{{"@type" : "Product"}}}}</script><p>R$ 1.234,56</p><a href="/produto/1">p</a><div class="product-grid"></div>'
        WHEN 5 THEN '<a href="https://api.whatsapp.com/send">w</a><a href="/instagram.com/local">i</a><form action="x" id="contato"></form>'
        WHEN 6 THEN '<link href="/wp-content/plugins/woocommerce/x.css"><p>LOJA EM CONSTRUÇÃO</p>'
        WHEN 7 THEN '<i class="chat-widget"></i><input type="search" name="q"><a href="/customer/account">Login</a>'
        WHEN 8 THEN '<script>Tiendanube; magento; Mage.Cookies</script><i class="minicart"></i>'
        WHEN 9 THEN '<a href="whatsapp://send?text=x&phone=5521987654321">w</a><script src="//static.zdassets.com/z.js"></script><a href="/categorias">c</a>'
        WHEN 10 THEN '<meta property="og:type"  content="product"><div class="Product card"><span>preço</span></div><b>Finalizar compra</b>'
        ELSE '' END
        || CASE WHEN o.o_orderkey IS NULL THEN '' ELSE
          '<footer>' || CASE WHEN p.site % 4 = 3 THEN 'Outra' ELSE trim({TRADE_NAME}) END
          || ' - Praça SAO ' || 'NATION_' || {text('o_custkey % 25')} || '/' || {STATE}
          || ' (' || {AREA} || ') ' || {PHONE}
          || CASE WHEN p.site % 2 = 0 THEN ' CNPJ ' || {BRANCH} ELSE '' END || '</footer>' END
        || '</article>') AS html_body,
      CASE WHEN p.site % 7 = 5 THEN 'Contabilidade e Domínio' WHEN p.site % 7 = 6 THEN 'registro.br'
        ELSE '' END AS title_word
    FROM (SELECT page_id, html, {whole('page_id / 14')} AS site FROM {{pages}}) p
    LEFT JOIN {{orders}} o ON o.o_orderkey = 10 * p.site""",
    # Place search results: four per branch, in search order.
    "places": " UNION ALL ".join(
        f"""
    SELECT {BRANCH} AS cnpj, {pos} AS position,
      'place-' || {text('o_orderkey')} || '-{pos}' AS place_id,
      {name} AS display_name,
      CASE WHEN (o_orderkey + {pos}) % 3 = 0 THEN 'Rua ' || o_orderpriority || ', Outra Cidade - XX'
        ELSE 'RUA ' || o_orderpriority || ', São NATION_' || {text('o_custkey % 25')} || ' - '
          || {STATE} || ', ' || ({pad('(o_orderkey * 37) % 100000000', 8)}) END AS formatted_address,
      CASE WHEN (o_orderkey + {pos}) % 4 = 0 THEN NULL
        ELSE '+55 (' || {AREA} || ') ' || {PHONE} END AS national_phone,
      CASE WHEN o_orderkey % 2 = 0 THEN 'https://loja' || {text('o_orderkey % 600')} || '.com.br/'
        ELSE NULL END AS website,
      CASE WHEN (o_orderkey + {pos}) % 5 = 0 THEN 'CLOSED' ELSE 'OPERATIONAL' END
        AS business_status
    FROM {{orders}}"""
        for pos, name in enumerate(
            (TRADE_NAME, f"{TRADE_NAME} || ' unidade'", "'zzzzqqqw'", "'zzqq'")
        )
    ),
    # Records of an external lead provider for some branches.
    "providers": f"""
    SELECT {moved("o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", BRANCH)} AS cnpj,
      CASE WHEN o_orderkey % 3 = 0 THEN 'http://www.loja' || {text('o_orderkey % 600')} || '.com.br'
        WHEN o_orderkey % 3 = 1 THEN '' ELSE NULL END AS website,
      CASE WHEN o_orderkey % 4 = 0 THEN 'R$ 1M' ELSE '' END AS faixa_faturamento_empresa,
      CASE WHEN o_orderkey % 4 = 1 THEN 'R$ 2M' ELSE NULL END AS faixa_faturamento_cnpj,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Admin ' || {text('o_custkey')} ELSE NULL END
        AS administrador
    FROM {{orders}}""",
    # Enrichment attempts: one per event; a run is a day, a company is a user.
    "attempts": f"""
    SELECT event_id, {pad('user_id', 14)} AS cnpj, ts,
      CAST(substr({text('ts')}, 9, 2) AS int) AS run_id,
      CASE event_type WHEN 'view' THEN 'done' WHEN 'click' THEN 'partial' WHEN 'signup'
        THEN 'no_site' WHEN 'error' THEN 'failed' ELSE 'pending' END AS enrich_status,
      CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 404 WHEN 'signup' THEN 403
        WHEN 'purchase' THEN 429 ELSE NULL END AS status,
      value
    FROM {{events}}""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# Bytes of a given table's files per part of heavy work: what a task sorts or keeps then has one size,
# however large the table is.
PART_BYTES = 16 << 20
# The same where the rows of a part become wide and are sorted at once, as for a join on the key they are dealt by.
SORTED_PART_BYTES = 2 << 20
# Columns that rows are dealt by where the first two would not do: what is read only for the deal makes the tasks
# that read a large row group read more. A partner row needs these four for its id.
DEALT_BY = {"lineitem": ("l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")}


_SAVED: dict[tuple[str, str, str], str] = {}
_ROOTS: dict[tuple[str, str, str], ByRoot] = {}
_HOT: dict[tuple[str, str, str], list[str]] = {}


class Inputs:
    """Registry-shaped DataFrames over one folder of the given tables.

    A derived table that is one projection of a given table is read through that projection, so that a
    query makes only the columns it uses. Tables that cost a join or read pages are saved once per
    session under the shared folder, as a load job would, and read back.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def parts(self, *names: str, part_bytes: int | None = None) -> int:
        """Parts of the largest of these given tables for heavy work: one per core or PART_BYTES."""
        size = max(stored_bytes(self.spark, f"{self.folder}/{name}.parquet") for name in names)
        return max(self.spark.sparkContext.defaultParallelism, -(-size // (part_bytes or PART_BYTES)))

    def spread_table(self, name: str) -> DataFrame:
        """A given table for heavy work, redistributed before it. Rows go by a hash of columns (DEALT_BY):
        unlike round robin that needs no sort to be the same in every attempt. The number of parts in which
        Spark reads a file says nothing: row groups cannot be cut, so few parts may hold all rows. Filters
        stay above the move, else the few reading tasks would do their work."""
        rows = self.table(name)
        return settled(rows.repartition(self.parts(name), *DEALT_BY.get(name, rows.columns[:2])))

    def dealt_table(self, name: str, key: str) -> DataFrame:
        """A given table dealt by the key that its projection makes of a row (an SQL expression): few narrow
        columns move, and what joins the wide rows on that key later finds them where they lie."""
        return settled(self.table(name).repartition(self.dealt_parts(name), F.expr(key)))

    def dealt_parts(self, name: str) -> int:
        return self.parts(name, part_bytes=SORTED_PART_BYTES)

    def raw(self, name: str, spread: bool = False, key: str | None = None) -> DataFrame:
        """One of the shared projections, as it is; with ``key`` dealt by it."""
        sql, read = RAW[name], self.spread_table if spread else self.table
        if key is not None:
            def read(table: str) -> DataFrame:
                return self.dealt_table(table, key)
        used = {t: read(t) for t in TABLES if "{" + t + "}" in sql}
        return self.spark.sql(sql, **used)

    def saved(
        self, name: str, build: Callable[[], DataFrame], spread: str | None = None
    ) -> DataFrame:
        """``spread`` saves one file per core, by that key: tables that heavy work reads must not
        inherit the few files of a small source."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _SAVED:
            rows, path = build(), new_folder(self.spark, name)
            if spread:
                rows = rows.repartition(self.spark.sparkContext.defaultParallelism, spread)
            rows.write.parquet(path)
            _SAVED[key] = path
        return self.spark.read.parquet(_SAVED[key])

    @property
    def branch_parts(self) -> int:
        return self.dealt_parts("orders")

    def lay(self, rows: DataFrame) -> DataFrame:
        """Rows laid out by branch key like the tables that ``dealt_table`` deals by it."""
        return rows.repartition(self.branch_parts, "cnpj")

    def saved_by_branch(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """As ``saved``, stored in buckets of the branch key, one file each: joins on it find the rows
        where ``lay`` puts those of other tables."""
        key = (self.spark.sparkContext.applicationId, self.folder, f"{name}_by_branch")
        if key not in _SAVED:
            path, table = new_folder(self.spark, name), f"{name}_{uuid.uuid4().hex}"
            (self.lay(build()).write.format("parquet").bucketBy(self.branch_parts, "cnpj").sortBy("cnpj")
             .option("path", path).saveAsTable(table))
            _SAVED[key] = table
        return self.spark.table(_SAVED[key])

    def lookup(self, name: str, kind: str) -> DataFrame:
        return self.saved(f"typed_{name}", lambda: clean_rows(self.raw(name, spread=True), kind, COMPETENCE))

    def facts_of(self, name: str, kind: str) -> DataFrame:
        """A table with a company root: one projection, nothing stored or shuffled by root."""
        rows = clean_rows(self.raw(name, spread=True), kind, COMPETENCE)
        return settled(rows.withColumn("updated_at", self.now))

    def hot_roots(self) -> list[str]:
        key = (self.spark.sparkContext.applicationId, self.folder, "hot_roots")
        if key not in _HOT:
            _HOT[key] = by_root.hot_roots(
                [self.raw(name).select("cnpj_basico") for name in ("raw_estabelecimentos", "raw_socios")])
        return _HOT[key]

    def hot_partner_roots(self) -> list[str]:
        """Roots with very many partners; a company has one row of its own."""
        key = (self.spark.sparkContext.applicationId, self.folder, "hot_partner_roots")
        if key not in _HOT:
            _HOT[key] = by_root.hot_roots([self.raw("raw_socios").select("cnpj_basico")])
        return _HOT[key]

    def by_root(self, name: str, kind: str) -> ByRoot:
        """The same table stored by root, for views that join on it again and again. A bucket is written
        and read by one task, so their number follows the largest table, the same for all."""
        key = (self.spark.sparkContext.applicationId, self.folder, f"root_{name}")
        if key not in _ROOTS:
            buckets = self.parts("customer", "orders", "lineitem")
            _ROOTS[key] = by_root.store(
                self.facts_of(name, kind), new_folder(self.spark, f"root_{name}"), buckets, self.hot_roots())
        return _ROOTS[key]

    @property
    def now(self):
        return F.lit(NOW).cast("timestamp")

    @cached_property
    def registry(self) -> Tables:
        return Registry(self)

    @cached_property
    def population(self) -> DataFrame:
        return self.raw("population")

    @cached_property
    def state(self) -> DataFrame:
        """Stored enrichment state with typed time stamps and reason lists."""
        reasons = F.when(F.col("reasons_text") == "", F.array().cast("array<string>")).otherwise(
            F.split("reasons_text", r"\|")
        )
        times = (
            "next_retry_at", "processing_started_at", "google_places_checked_at", "enriched_at",
        )
        return self.raw("state", key=STATE_KEY).withColumns(
            {
                "site_validation_reasons": reasons,
                **{t: F.col(t).cast("timestamp") for t in times},
                "sinais": F.struct("porte", "opcao_mei", "cnpj_on_site"),
                "decisor_qualificacao": F.lit("49"),
                "plataformas_detectadas": F.array_compact(F.array("plataforma")),
                "presence_score": F.col("digital_score"),
                "commerce_score": F.col("digital_score"),
                "fit_score": F.col("digital_score"),
                "pain_score": F.col("digital_score"),
            }
        ).drop("reasons_text")

    @cached_property
    def site_pages(self) -> DataFrame:
        """Crawled pages; some titles get a word in front."""

        def build() -> DataFrame:
            titled = F.replace(
                F.col("html_body"), F.lit("<title>"), F.concat(F.lit("<title>"), "title_word")
            )
            return self.raw("site_pages").withColumn("html", titled).drop("html_body", "title_word")

        return self.saved("site_pages", build, spread="page_id")

    @cached_property
    def places(self) -> DataFrame:
        return self.raw("places", key=BRANCH)

    @cached_property
    def providers(self) -> DataFrame:
        return self.raw("providers", key=PROVIDER_KEY)

    @property
    def partners_by_root(self) -> DataFrame:
        """Partners dealt by their root, a few narrow columns: a task holds all rows of a company, so that what it
        keeps of them moves once per company."""
        return clean_rows(self.raw("raw_socios", key=PARTNER_ROOT), "Socios", COMPETENCE)

    @property
    def candidates_by_branch(self) -> DataFrame:
        kept = (self.spark.sparkContext.applicationId, self.folder, "candidates") in _SAVED
        return self.saved_by_branch("candidates", lambda: self.candidates if kept else self._made_candidates())

    @cached_property
    def facts(self) -> DataFrame:
        """Analysed pages, saved because attempts and site roll-ups both read them."""
        return self.saved("facts", lambda: analyze_pages(self.site_pages))

    @cached_property
    def complete(self) -> DataFrame:
        return stored_companies(self.registry.roots, self.registry)

    @cached_property
    def candidates(self) -> DataFrame:
        """Made from the plain tables: what is not a candidate leaves before anything is shuffled, and
        before the other columns are cleaned."""
        return self.saved("candidates", self._made_candidates)

    def _made_candidates(self) -> DataFrame:
        texts = {c: clean_text(F.col(c)) for c in ("situacao_cadastral", "cnae_fiscal_principal")}
        raw = self.raw("raw_estabelecimentos", spread=True)
        kept = raw.filter(
            (texts["situacao_cadastral"] == K.ACTIVE_STATUS)
            & texts["cnae_fiscal_principal"].isin(*K.RETAIL_CNAES))
        branches = settled(
            clean_rows(kept, "Estabelecimentos", COMPETENCE).withColumn("updated_at", self.now))
        tables = ChainMap({"estabelecimentos": branches}, self.registry)
        return prospect_candidates(complete_companies(tables))


class Registry(Mapping):
    """The typed registry tables of an input folder; ``roots`` has those with a company root stored by it,
    each when first asked for."""

    SOURCES = {
        "empresas": ("raw_empresas", "Empresas"),
        "estabelecimentos": ("raw_estabelecimentos", "Estabelecimentos"),
        "socios": ("raw_socios", "Socios"),
        "simples": ("raw_simples", "Simples"),
        "cnaes": ("raw_cnaes", "Cnaes"),
        "municipios": ("raw_municipios", "Municipios"),
        "naturezas_juridicas": ("raw_naturezas", "Naturezas"),
    }

    BY_ROOT = ("empresas", "estabelecimentos", "socios", "simples")

    def __init__(self, inputs: Inputs):
        self.inputs = inputs

    @property
    def roots(self) -> Roots:
        return Roots(self.inputs)

    def __getitem__(self, table: str) -> DataFrame:
        make = self.inputs.facts_of if table in self.BY_ROOT else self.inputs.lookup
        return make(*self.SOURCES[table])

    def __iter__(self):
        return iter(self.SOURCES)

    def __len__(self):
        return len(self.SOURCES)


class Roots(Mapping):
    """The tables with a company root, each stored by it when first asked for."""

    def __init__(self, inputs: Inputs):
        self.inputs = inputs

    def __getitem__(self, table: str) -> ByRoot:
        return self.inputs.by_root(*Registry.SOURCES[table])

    def __iter__(self):
        return iter(Registry.BY_ROOT)

    def __len__(self):
        return len(Registry.BY_ROOT)

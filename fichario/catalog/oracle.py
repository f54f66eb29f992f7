"""Equivalent SQL of the registered queries, written for the checking database.

The raw input projections are shared with ``inputs``; everything after them is written here on its
own, without the column functions of the library. ``ORACLE`` holds one statement per query.
"""

from __future__ import annotations

import re

from fichario import constants as K
from fichario.catalog.inputs import COMPETENCE, NOW, RAW, TABLES, YEAR
from fichario.schemas import DATASETS


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# White space as the cleaning rule sees it.
SPACES = "||".join(
    f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232,
                          8233, 8239, 8287, 12288)
)
NOW_TS = f"TIMESTAMP '{NOW}'"
_DATE = r"^([0-9]{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"


def clean(x: str) -> str:
    return f"nullif(trim({x}, {SPACES}), '')"


def as_date(x: str) -> str:
    t = f"trim({x}, {SPACES})"
    parts = (
        f"regexp_extract({t}, '{_DATE}', 1) || lpad(regexp_extract({t}, '{_DATE}', 2), 2, '0')"
        f" || lpad(trim(regexp_extract({t}, '{_DATE}', 3)), 2, '0')"
    )
    return (
        f"CASE WHEN regexp_matches({t}, '{_DATE}') AND substr({t}, 1, 4) <> '0000'"
        f" THEN CAST(try_strptime({parts}, '%Y%m%d') AS DATE) END"
    )


def as_amount(x: str) -> str:
    return (
        f"TRY_CAST(replace(replace(coalesce({clean(x)}, '0'), '.', ''), ',', '.')"
        " AS DECIMAL(18,2))"
    )


def typed(table: str, kind: str) -> str:
    columns = []
    for c in DATASETS[kind].columns:
        rule = as_date if c.startswith("data_") else as_amount if c == "capital_social" else clean
        columns.append(f"{rule(c)} AS {c}")
    return f"SELECT {', '.join(columns)} FROM {table}"


def txt(*names: str) -> str:
    """Columns as text, NULL as empty text."""
    return ", ".join(f"coalesce(CAST({n} AS VARCHAR), '') AS {n.split('.')[-1]}" for n in names)


def ts(x: str, name: str, null: str | None = None) -> str:
    shown = f"strftime({x}, '%Y-%m-%d %H:%M:%S')"
    return f"{shown if null is None else f'coalesce({shown}, {null!r})'} AS {name}"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


_WORD = r"[^\p{L}\p{N}_]"


def norm(x: str) -> str:
    """Normalised name; the suffix pass runs twice because neighbours share a separator."""
    t = f"lower(strip_accents(coalesce({x}, '')))"
    for _ in range(2):
        t = (
            f"regexp_replace({t}, '(^|{_WORD})(?:ltda|me|epp|eireli|sa|s/a|limitada|microempresa)"
            f"($|{_WORD})', '\\1 \\2', 'g')"
        )
    return f"trim(regexp_replace({t}, '{_WORD}+', ' ', 'g'))"


def phone(x: str) -> str:
    d0 = digits(x)
    d1 = f"CASE WHEN starts_with({d0}, '00') THEN substr({d0}, 3) ELSE {d0} END"
    d2 = f"CASE WHEN length({d1}) IN (10, 11) AND NOT starts_with({d1}, '55') THEN '55' || {d1} ELSE {d1} END"
    return (
        f"CASE WHEN length({d2}) IN (12, 13) AND starts_with({d2}, '55')"
        f" AND substr({d2}, 3, 2) IN ({quoted(K.AREA_CODES)})"
        f" AND replace(substr({d2}, 5), substr({d2}, 5, 1), '') <> '' THEN {d2} END"
    )


def email_domain(x: str) -> str:
    return f"CASE WHEN contains({x}, '@') THEN regexp_extract(lower(trim({x}, {SPACES})), '@([^@]*)$', 1) END"


def email_kind(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR NOT contains({x}, '@') THEN 'invalido'"
        f" WHEN {email_domain(x)} IN ({quoted(K.FREE_EMAIL_DOMAINS)}) THEN 'gratuito'"
        " ELSE 'corporativo' END"
    )


def email_role(x: str) -> str:
    local = f"lower(split_part({x}, '@', 1))"
    starts = " OR ".join(f"starts_with({local}, '{p}')" for p in K.ACCOUNTING_PREFIXES)
    return (
        f"CASE WHEN {x} IS NULL OR NOT contains({x}, '@') OR {local} = '' THEN 'unknown'"
        f" WHEN {starts} THEN 'accounting' WHEN {local} IN ({quoted(K.SALES_WORDS)}) THEN 'sales'"
        f" WHEN {local} IN ({quoted(K.SUPPORT_WORDS)}) THEN 'support'"
        f" WHEN regexp_matches({local}, '^[a-z]+\\.[a-z]+$') THEN 'personal' ELSE 'general' END"
    )


def cnae7(x: str) -> str:
    t = f"coalesce(trim({x}, {SPACES}), '')"
    return f"CASE WHEN regexp_matches({t}, '^[0-9]{{1,6}}$') THEN lpad({t}, 7, '0') ELSE {t} END"


RETAIL = quoted(K.RETAIL_CNAES)
SECONDARY = (
    f"list_filter(list_transform(string_split(coalesce(cnaes_fiscais_secundarios, ''), ','),"
    f" lambda s: {cnae7('s')}), lambda s: length(s) = 7)"
)
VALID_PHONE = (
    f"length({digits("coalesce(ddd1, '')")}) = 2 AND length({digits("coalesce(telefone1, '')")}) >= 8"
    f" AND regexp_matches({digits("coalesce(telefone1, '')")}, '[1-9]')"
)
CITY4 = f"CASE WHEN length(coalesce(trim(municipio, {SPACES}), '')) < 4 THEN lpad(coalesce(trim(municipio, {SPACES}), ''), 4, '0') ELSE trim(municipio, {SPACES}) END"
UF = "upper(coalesce(uf, ''))"


def size_band(mei: str, porte: str, simples: str, capital: str) -> tuple[str, str]:
    cap = f"coalesce(CAST({capital} AS DOUBLE), 0)"
    branches = [
        (f"{mei} = 'S'", K.BAND_MEI, K.BAND_SOURCE_REGISTRY),
        *[(f"{porte} = '{p}'", label, K.BAND_SOURCE_REGISTRY) for p, label in K.BAND_BY_PORTE.items()],
        (f"{simples} = 'S'", K.BAND_SIMPLES, K.BAND_SOURCE_REGISTRY),
        (f"{cap} >= 10000000", K.BAND_CAPITAL_HIGH, K.BAND_SOURCE_CAPITAL),
        (f"{cap} >= 1000000", K.BAND_CAPITAL_MEDIUM, K.BAND_SOURCE_CAPITAL),
    ]
    one = "CASE " + " ".join(f"WHEN {c} THEN '{a}'" for c, a, _ in branches) + f" ELSE '{K.BAND_UNKNOWN}' END"
    two = "CASE " + " ".join(f"WHEN {c} THEN '{b}'" for c, _, b in branches) + f" ELSE '{K.BAND_SOURCE_LOCAL}' END"
    return one, two


# --- Page rules ---


def hit(pattern: str, flags: str = "i", column: str = "html") -> str:
    p = pattern.replace("'", "''")
    return f"regexp_matches({column}, '(?{flags}){p}')"


def words(values, column: str = "lower(html)") -> str:
    return "(" + " OR ".join(f"contains({column}, '{v}')" for v in values) + ")"


FLAG_SQL = {
    "has_product_page": "regexp_matches(lower(html), '/produto/|/products/|/product/|/p/[0-9]')",
    "has_product_schema": "(" + " OR ".join(
        [hit(r'"@type"\s*:\s*"Product"'), hit(r"application/ld\+json[^>]*>[^<]*Product"),
         hit(r'property="og:type"\s+content="product"')]
    ) + ")",
    "has_price": "(" + hit(r'class="[^"]*product[^"]*".*?(R\$|\bprice\b|\bpreço\b)', "is") + " OR "
    + "regexp_matches(html, 'R\\$\\s?[0-9]{1,3}(?:\\.[0-9]{3})*,[0-9]{2}'))",
    "has_cart": words(K.CART_WORDS),
    "has_checkout": words(K.CHECKOUT_WORDS),
    "has_add_to_cart": words(K.ADD_TO_CART_WORDS),
    "has_catalog": words(K.CATALOG_WORDS),
    "has_search": words(K.SEARCH_WORDS),
    "has_customer_login": words(K.LOGIN_WORDS),
    "has_contact_form": "regexp_matches(lower(html), '<form[^>]+(contato|contact|fale conosco)')",
    "coming_soon": hit("em breve|coming soon|under construction|loja em construção|site em manutenção"),
}
CHAT_SQL = (
    "CASE "
    + " ".join(f"WHEN {hit('|'.join(ps))} THEN '{name}'" for name, ps in K.CHAT_PATTERNS.items())
    + f" WHEN {hit('|'.join(K.GENERIC_CHAT_WORDS))} THEN 'custom' END"
)
_HITS = {
    name: " + ".join(f"CAST({hit(p)} AS INT)" for p in ps) for name, ps in K.PLATFORM_PATTERNS.items()
}
_CONF = {
    name: f"CASE WHEN h_{name} >= 3 THEN 95 WHEN h_{name} = 2 THEN 75 WHEN h_{name} = 1 THEN 45 ELSE 0 END"
    for name in _HITS
}


def ranked(with_confidence: bool) -> str:
    items = [
        f"CASE WHEN {_CONF[n]} = {level} THEN '{n}{f':{level}' if with_confidence else ''}' END"
        for level in (95, 75, 45) for n in _HITS
    ]
    return f"concat_ws('|', {', '.join(items)})"


FLAGS = tuple(FLAG_SQL)
HOST = r"regexp_replace(regexp_extract(lower(url), '^[a-z]+://(?:[^/@]*@)?([^/:?#]+)', 1), '^www\.', '')"
PATHS = ["", *(p.rstrip("/") for p in K.INNER_PATHS)]
CHATS, PLATFORMS = [*K.CHAT_PATTERNS, "custom"], list(K.PLATFORM_PATTERNS)
ORIGIN = r"regexp_extract(url, '^([a-z]+:)//', 1)"
SITE = r"regexp_extract(url, '^([a-z]+://[^/]+)', 1)"
IS_HTML = (
    "coalesce(status BETWEEN 200 AND 299 AND (contains(lower(content_type), 'text/html')"
    " OR contains(lower(content_type), 'application/xhtml')), false)"
)


def merged(source: str, order: str) -> str:
    """Signals of a site merged in the given order."""
    flags = ", ".join(f"coalesce(bool_or({f}), false) AS {f}" for f in FLAGS)
    return f"""
    SELECT s.host, {flags}, coalesce(bool_or(chat_provider IS NOT NULL), false) AS has_chat,
      max(plataforma_confianca) AS plataforma_confianca,
      coalesce(arg_min(chat_provider, {order} * 100 + list_position([{quoted(CHATS)}], chat_provider)) FILTER (chat_provider IS NOT NULL), '') AS chat_provider,
      coalesce(arg_min(plataforma, {order} * 100 + list_position([{quoted(PLATFORMS)}], plataforma)) FILTER (plataforma IS NOT NULL), '') AS plataforma,
      coalesce(any_value(p.lista), '') AS plataformas_detectadas
    FROM {source} s LEFT JOIN (
      SELECT host, string_agg(name, '|' ORDER BY seen) AS lista FROM (
        SELECT host, name, min({order} * 100 + pos) AS seen FROM (
          SELECT host, {order}, unnest(string_split(plats, '|')) AS name,
            generate_subscripts(string_split(plats, '|'), 1) AS pos
          FROM {source} WHERE plats <> '') GROUP BY 1, 2) GROUP BY 1) p ON p.host = s.host
    GROUP BY s.host"""


# --- Score rules over the state ---


def pts(*terms) -> str:
    return " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in terms)


def clamp(x: str) -> str:
    return f"greatest(0, least(100, {x}))"


STRONG = (
    "(has_checkout OR (has_cart AND has_add_to_cart) OR (has_product_schema AND has_price"
    " AND coalesce(plataforma, '') <> ''))"
)
PRESENCE = clamp(
    "CASE WHEN site_valid THEN 30 WHEN site_reachable THEN 10 ELSE 0 END"
    " + CASE WHEN whatsapp_valid THEN 20 WHEN whatsapp_detected THEN 3 ELSE 0 END + "
    + pts(("email_tipo = 'corporativo'", 15), ("coalesce(instagram_url, '') <> ''", 15),
          ("coalesce(linkedin_url, '') <> ''", 10),
          ("google_place_match_score >= 70 AND google_business_status = 'OPERATIONAL'", 10))
)
_COMMERCE = (
    "CASE WHEN plataforma_confianca >= 80 THEN 20 WHEN plataforma_confianca >= 50 THEN 10"
    " WHEN coalesce(plataforma, '') <> '' THEN 5 ELSE 0 END + "
    + pts(("has_product_schema", 20), ("has_product_page", 15), ("has_price", 10),
          ("has_add_to_cart", 15), ("has_cart", 10), ("has_checkout", 10),
          ("has_catalog AND NOT has_checkout", 5))
)
COMMERCE = clamp(f"CASE WHEN coming_soon THEN least({_COMMERCE}, 25) ELSE {_COMMERCE} END")
CONFIDENCE = clamp(
    "CASE WHEN site_valid THEN 25 WHEN site_reachable THEN 5 ELSE 0 END + "
    + pts(("google_place_match_score >= 70", 20), ("email_tipo = 'corporativo' AND site_valid", 15),
          ("whatsapp_valid", 15), ("cnpj_on_site", 20),
          ("domain_is_shared AND NOT cnpj_on_site", -30),
          ("coalesce(site_match_status, '') = 'rejected_webmail'", -100),
          ("whatsapp_detected AND NOT whatsapp_valid", -15),
          ("contains(reasons_text, 'title_incompativel')", -50))
)
PAIN = clamp(
    "CASE WHEN has_chat THEN 0 ELSE "
    + pts(("whatsapp_valid", 20), ("site_valid", 15), ("commerce_score >= 40", 20),
          ("has_contact_form", 10),
          ("CAST(whatsapp_valid AS INT) + CAST(coalesce(instagram_url, '') <> '' AS INT)"
           " + CAST(email_tipo = 'corporativo' AS INT) + CAST(site_valid AS INT) >= 2", 10))
    + " END"
)


def fit(priority: str, penalty: int) -> str:
    main = "coalesce(cnae_fiscal_principal, '') <> ''"
    first = f"CASE WHEN cnae_fiscal_principal IN ({priority}) THEN 30 WHEN {main} THEN 10 ELSE 0 END"
    return clamp(
        f"{first} + CASE porte WHEN '03' THEN 15 WHEN '05' THEN 20 ELSE 0 END"
        " + CASE commerce_maturity WHEN 'ecommerce_confirmado' THEN 20"
        " WHEN 'ecommerce_provavel' THEN 10 ELSE 0 END + "
        + pts(("has_catalog", 10), ("opcao_mei = 'S'", -penalty))
    )


def scored(source: str, fit_sql: str) -> str:
    """All scores of the rows of ``source``, in their order of dependence."""
    old = (
        "presence_maturity, commerce_maturity, confidence_score, lead_score, lead_classification,"
        " digital_score, digital_maturity, score_version"
    )
    return f"""
    SELECT *, lead_score AS digital_score, commerce_maturity AS digital_maturity,
      'v2' AS score_version,
      CASE WHEN lead_score >= 80 THEN 'lead_prioritario' WHEN lead_score >= 60 THEN 'lead_quente'
        WHEN lead_score >= 40 THEN 'lead_medio' ELSE 'lead_frio' END AS lead_classification
    FROM (SELECT *, CAST({clamp("round_even(fit_score * CAST(0.40 AS DOUBLE) + pain_score * CAST(0.35 AS DOUBLE) + confidence_score * CAST(0.25 AS DOUBLE), 0)")} AS INT) AS lead_score
    FROM (SELECT *, {fit_sql} AS fit_score, {PAIN} AS pain_score
    FROM (SELECT *, CASE WHEN commerce_score >= 60 AND {STRONG} THEN 'ecommerce_confirmado'
        WHEN commerce_score >= 40 THEN 'ecommerce_provavel'
        WHEN commerce_score >= 20 THEN 'ecommerce_indicio' ELSE 'sem_ecommerce' END
        AS commerce_maturity,
      CASE WHEN presence_score >= 70 THEN 'presenca_multicanal'
        WHEN presence_score >= 45 THEN 'presenca_ativa'
        WHEN presence_score >= 20 THEN 'presenca_basica' ELSE 'offline' END AS presence_maturity
    FROM (SELECT * EXCLUDE ({old}), {PRESENCE} AS presence_score, {COMMERCE} AS commerce_score,
      {CONFIDENCE} AS confidence_score FROM {source}))))"""


# --- Qualification over candidates joined to the state ---

_MAIL = f"trim(coalesce(nullif(email, ''), email_original, ''), {SPACES})"
_ROLE = email_role(_MAIL)
_CORP = f"(email_tipo = 'corporativo' AND {_MAIL} <> '')"
_TEL = f"trim(coalesce(telefone_1, ''), {SPACES})"
_CHANNEL_RULES = [
    (f"{_CORP} AND {_ROLE} IN ('sales', 'support', 'general')", "'email_corporativo'", _MAIL,
     f"CASE WHEN {_ROLE} = 'sales' THEN 85 ELSE 75 END", _ROLE),
    ("whatsapp_valid AND coalesce(whatsapp_number_normalized, '') <> ''", "'whatsapp_confirmado'",
     "coalesce(nullif(whatsapp_url, ''), 'https://wa.me/' || whatsapp_number_normalized)", "90",
     "'sales'"),
    (f"{_TEL} <> ''", "'telefone_comercial'", _TEL, "60", "'general'"),
    (f"{_CORP} AND {_ROLE} IN ('finance', 'accounting')", "'email_corporativo'", _MAIL, "40", _ROLE),
    ("coalesce(telefone_candidato_whatsapp, '') <> ''", "'whatsapp_candidato'",
     "telefone_candidato_whatsapp", "25", "'unknown'"),
    ("coalesce(instagram_url, '') <> ''", "'instagram'", "instagram_url", "20", "'unknown'"),
]


def _choose(part: int, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {r[0]} THEN {r[part]}" for r in _CHANNEL_RULES) + f" ELSE {otherwise} END"


CHANNEL_COLUMNS = (
    f"{_choose(1, 'NULL')} AS contact_channel, {_choose(2, 'NULL')} AS contact_value,"
    f" {_choose(3, '0')} AS contact_confidence, {_choose(4, chr(39) + 'unknown' + chr(39))} AS contact_role"
)


def qualified(source: str, min_confidence: int, min_lead: int) -> str:
    confidence = "coalesce(nullif(confidence_score, 0), nullif(digital_score, 0), 0)"
    lead = "coalesce(nullif(lead_score, 0), nullif(digital_score, 0), 0)"
    commerce = "coalesce(nullif(commerce_maturity, ''), digital_maturity, '')"
    bad_title = "(coalesce(site_match_status, '') <> '' AND contains(reasons_text, 'title_incompativel'))"
    return f"""
    SELECT *, CASE WHEN coalesce(site_match_status, '') = 'rejected_webmail' THEN 'blocked'
        WHEN hard > 0 THEN 'rejected' WHEN rejection_reasons <> '' THEN 'review_required'
        ELSE 'qualified' END AS qualification_status
    FROM (SELECT *,
      CASE WHEN coalesce(site_match_status, '') = 'rejected_webmail' THEN 'site_webmail' ELSE
        concat_ws('|', CASE WHEN {bad_title} THEN 'site_incompativel_cnae' END,
          CASE WHEN contact_channel IS NULL OR contact_confidence < 50 THEN 'sem_canal_outreach_valido' END,
          CASE WHEN {confidence} < {min_confidence} THEN 'confidence_baixa:' || {confidence} || '<{min_confidence}' END,
          CASE WHEN {lead} < {min_lead} THEN 'lead_baixo:' || {lead} || '<{min_lead}' END,
          CASE WHEN NOT site_valid AND site_reachable AND NOT {bad_title}
            AND {commerce} NOT IN ('ecommerce_confirmado', 'ecommerce_provavel') THEN 'site_nao_validado' END,
          CASE WHEN contact_channel = 'instagram' THEN 'instagram_nao_automatico' END) END
        AS rejection_reasons,
      CASE WHEN coalesce(site_match_status, '') = 'rejected_webmail' THEN '' ELSE
        concat_ws('|', CASE WHEN coalesce(decisor_nome, '') <> '' THEN 'decisor_cadastral' END,
          CASE WHEN contact_channel IN ('whatsapp_confirmado', 'email_corporativo', 'telefone_comercial')
            THEN contact_channel END,
          CASE WHEN {commerce} = 'ecommerce_confirmado' THEN 'ecommerce_confirmado' END) END
        AS qualification_reasons,
      CAST(contact_channel IS NULL OR contact_confidence < 50 AS INT)
        + CAST({confidence} < {min_confidence} AS INT) + CAST({lead} < {min_lead} AS INT) AS hard
    FROM {source})"""


# --- Named steps; a statement gets the ones it uses, in order of use ---

_BAND, _BAND_SOURCE = size_band("opcao_mei", "porte", "opcao_simples", "capital_social")
_CANDIDATE_COLUMNS = (
    "cnpj, cnpj_basico, razao_social, nome_fantasia, capital_social, uf, municipio_descricao,"
    " telefone_1, email, logradouro, cep, cnae_fiscal_principal, opcao_simples"
)

STEPS: dict[str, str] = {
    **{name: sql.format(**{t: t for t in TABLES}) for name, sql in RAW.items()},
    "empresas": typed("raw_empresas", "Empresas"),
    "estabelecimentos": (
        "SELECT *, coalesce(cnpj_basico, '') || coalesce(cnpj_ordem, '') || coalesce(cnpj_dv, '')"
        f" AS cnpj FROM ({typed('raw_estabelecimentos', 'Estabelecimentos')})"
    ),
    "socios": "SELECT *, sha256(concat_ws('|', "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in DATASETS["Socios"].columns)
    + f")) AS id FROM ({typed('raw_socios', 'Socios')})",
    "simples": typed("raw_simples", "Simples"),
    "cnaes": typed("raw_cnaes", "Cnaes"),
    "municipios": typed("raw_municipios", "Municipios"),
    "naturezas": typed("raw_naturezas", "Naturezas"),
    "complete": f"""
    SELECT es.cnpj, e.cnpj_basico, e.razao_social, es.nome_fantasia, e.natureza_juridica,
      nj.descricao AS natureza_juridica_descricao, e.capital_social, e.porte, es.situacao_cadastral,
      es.data_inicio_atividade, es.cnae_fiscal_principal, c.descricao AS cnae_principal_descricao,
      es.logradouro, es.cep, es.uf, es.municipio, m.descricao AS municipio_descricao,
      concat_ws('', es.ddd1, es.telefone1) AS telefone_1,
      concat_ws('', es.ddd2, es.telefone2) AS telefone_2, lower(es.correio_eletronico) AS email,
      s.opcao_simples, s.opcao_mei, '{COMPETENCE}' AS source_competence
    FROM estabelecimentos es JOIN empresas e ON e.cnpj_basico = es.cnpj_basico
    LEFT JOIN cnaes c ON c.codigo = es.cnae_fiscal_principal
    LEFT JOIN municipios m ON m.codigo = es.municipio
    LEFT JOIN naturezas nj ON nj.codigo = e.natureza_juridica
    LEFT JOIN simples s ON s.cnpj_basico = es.cnpj_basico""",
    "candidates": f"SELECT * FROM complete WHERE situacao_cadastral = '02' AND cnae_fiscal_principal IN ({RETAIL})",
    "retail": f"""
    SELECT v.*, mp.populacao, mp.ano_referencia FROM candidates v
    JOIN population mp ON mp.uf = v.uf AND mp.codigo = v.municipio
    WHERE trim(coalesce(v.nome_fantasia, '')) <> '' AND trim(v.telefone_1) <> ''
      AND mp.populacao >= 100000""",
    "accepted": f"SELECT * FROM estabelecimentos WHERE situacao_cadastral = '02' AND {cnae7('cnae_fiscal_principal')} IN ({RETAIL})",
    "joined": f"""
    SELECT c.cnpj, c.email, c.telefone_1, c.opcao_simples, st.* EXCLUDE (cnpj)
    FROM candidates c JOIN state st ON st.cnpj = c.cnpj
    WHERE st.enrich_status IN ('done', 'partial', 'no_site', 'failed')""",
    "channelled": f"SELECT *, {CHANNEL_COLUMNS} FROM joined",
    "evaluated": qualified("channelled", 60, 60),
    "history": """
    SELECT cnpj, 'old' || cnpj_basico AS cnpj_basico, 'review_required' AS qualification_status,
      lead_score, enriched_at FROM state WHERE site_match_status <> 'rejected_webmail'""",
    "requalified": f"""
    SELECT coalesce(n.cnpj, o.cnpj) AS cnpj, coalesce(o.cnpj_basico, n.cnpj_basico) AS cnpj_basico,
      coalesce(n.qualification_status, o.qualification_status) AS qualification_status,
      CASE WHEN n.cnpj IS NULL THEN o.lead_score ELSE n.lead_score END AS lead_score,
      n.contact_channel,
      CASE WHEN n.cnpj IS NOT NULL THEN coalesce(nullif(n.lead_score, 0), n.digital_score) END
        AS digital_score,
      CASE WHEN n.cnpj IS NULL OR (o.cnpj IS NOT NULL AND n.qualification_status <> 'qualified')
        THEN o.enriched_at ELSE {NOW_TS} END AS qualified_at,
      CASE WHEN n.cnpj IS NULL THEN o.enriched_at ELSE {NOW_TS} END AS last_qualified_at,
      'nota ' || o.cnpj AS history_note
    FROM evaluated n FULL JOIN history o ON o.cnpj = n.cnpj""",
    "queue": """
    SELECT c.cnpj, st.cnpj IS NOT NULL AS has_state, st.* EXCLUDE (cnpj) FROM candidates c
    LEFT JOIN state st ON st.cnpj = c.cnpj""",
    "waiting": f"""
    SELECT * FROM queue WHERE (NOT has_state OR enrichment_version IS DISTINCT FROM 'v2'
      OR enrich_status = 'pending' OR (enrich_status IN ('failed', 'no_site')
        AND (next_retry_at IS NULL OR next_retry_at <= {NOW_TS})))
      AND (processing_run_id IS NULL OR processing_started_at < {NOW_TS} - INTERVAL 2 HOUR)""",
    "pg": """
    SELECT *, replace(html_body, '<title>', '<title>' || title_word) AS html FROM site_pages""",
    "hits": "SELECT *, " + ", ".join(f"{sql} AS h_{n}" for n, sql in _HITS.items()) + " FROM pg",
    "signals": f"""
    SELECT page_id, url, {HOST} AS host, coalesce(list_position([{quoted(PATHS)}],
        rtrim(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1), '/')) - 1, {len(PATHS)}) AS visit,
      {', '.join(f'{s} AS {n}' for n, s in FLAG_SQL.items())}, {CHAT_SQL} AS chat_provider,
      nullif(split_part({ranked(False)}, '|', 1), '') AS plataforma,
      greatest({', '.join(_CONF.values())}) AS plataforma_confianca, {ranked(False)} AS plats
    FROM hits""",
    "read_signals": f"""
    SELECT s.page_id, s.host, {', '.join(f'CASE WHEN {IS_HTML} THEN s.{f} END AS {f}' for f in FLAGS)},
      CASE WHEN {IS_HTML} THEN s.chat_provider END AS chat_provider,
      CASE WHEN {IS_HTML} THEN s.plataforma END AS plataforma,
      CASE WHEN {IS_HTML} THEN s.plataforma_confianca ELSE 0 END AS plataforma_confianca,
      CASE WHEN {IS_HTML} THEN s.plats ELSE '' END AS plats
    FROM signals s JOIN site_pages f ON f.page_id = s.page_id""",
    "rollup": merged("signals", "visit"),
    "links": f"""
    SELECT page_id, ord, CASE WHEN starts_with(h, '//') THEN {ORIGIN} || h
        WHEN starts_with(h, '/') THEN {SITE} || h ELSE h END AS href
    FROM (SELECT page_id, url, unnest(hs) AS h, generate_subscripts(hs, 1) AS ord FROM (
      SELECT page_id, url, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS hs FROM pg))""",
    "wa": f"""
    SELECT page_id, ord, number, {phone('number')} AS normalized FROM (
      SELECT page_id, ord, CASE WHEN contains(lower(regexp_extract(href, '//([^/?#]*)', 1)), 'wa.me')
        THEN nullif({digits("regexp_extract(href, '//[^/?#]*([^?#;]*)', 1)")}, '')
        ELSE url_decode(url_decode(replace(nullif(regexp_extract(href, '[?&]phone=([^&#]+)', 1), ''), '+', ' '))) END AS number
      FROM links WHERE {words(K.WHATSAPP_TOKENS, 'lower(href)')})""",
    "socials": """
    SELECT page_id, split_part(arg_min(href, ord) FILTER (contains(lower(href), 'instagram.com/')), '?', 1) AS instagram,
      split_part(arg_min(href, ord) FILTER (contains(lower(href), 'linkedin.com/')), '?', 1) AS linkedin
    FROM links GROUP BY 1""",
    "whatsapps": """
    SELECT page_id, true AS detected, arg_min(number, ord) FILTER (normalized IS NOT NULL) AS number,
      arg_min(normalized, ord) FILTER (normalized IS NOT NULL) AS normalized FROM wa GROUP BY 1""",
    "deciders": f"""
    SELECT cnpj_basico, nome_socio_razao_social AS decisor_nome, qualificacao_socio AS decisor_qualificacao
    FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY
      CASE WHEN qualificacao_socio IN ({quoted(K.ADMIN_QUALIFICATIONS)}) THEN 0 ELSE 1 END,
      data_entrada_sociedade ASC NULLS LAST, id) AS rk FROM socios) WHERE rk = 1""",
    "domains": f"""
    SELECT cnpj, email_dominio, CASE WHEN coalesce(email_dominio, '') = '' THEN 0
      ELSE count(*) OVER (PARTITION BY email_dominio) - 1 END AS domain_shared_count
    FROM (SELECT cnpj, {email_domain('email')} AS email_dominio FROM candidates)""",
    "profiled": f"""
    SELECT c.cnpj, c.cnpj_basico, c.razao_social, c.nome_fantasia, c.uf, c.municipio_descricao,
      c.telefone_1, c.email, c.logradouro, c.cep, c.cnae_fiscal_principal, c.porte, c.opcao_mei,
      d.email_dominio, d.domain_shared_count, {email_kind('c.email')} AS email_tipo,
      nullif(p.website, '') AS site_url,
      CASE WHEN nullif(p.website, '') IS NOT NULL THEN 'external_provider' END AS site_source,
      coalesce(nullif(p.faixa_faturamento_empresa, ''), nullif(p.faixa_faturamento_cnpj, ''))
        AS faturamento_estimado,
      CASE WHEN coalesce(nullif(p.faixa_faturamento_empresa, ''), nullif(p.faixa_faturamento_cnpj, ''))
        IS NOT NULL THEN 'speedio' END AS faturamento_estimado_fonte,
      coalesce(nullif(x.decisor_nome, ''), nullif(p.administrador, ''), x.decisor_nome) AS decisor_nome
    FROM candidates c JOIN domains d ON d.cnpj = c.cnpj
    LEFT JOIN deciders x ON x.cnpj_basico = c.cnpj_basico LEFT JOIN providers p ON p.cnpj = c.cnpj""",
    "page_keys": r"""
    SELECT *, lower(regexp_extract(url, '//([^/?#]*)', 1))
      || regexp_extract(url, '//[^/?#]*([^?#]*)', 1) AS url_key FROM pg""",
}


def tries(source: str) -> str:
    """Candidate URLs per company in order; the ordinal counts existing candidates only."""
    free = f"email_dominio NOT IN ({quoted(K.FREE_EMAIL_DOMAINS)})"
    own = f"email_tipo = 'corporativo' AND coalesce(email_dominio, '') <> '' AND {free}"
    key = (
        "lower(regexp_extract(candidate_url, '//([^/?#]*)', 1)) || coalesce(nullif("
        "regexp_extract(candidate_url, '//[^/?#]*([^?#]*)', 1), ''), '/')"
    )
    return f"""
    SELECT *, {key} AS url_key, row_number() OVER (PARTITION BY cnpj ORDER BY slot) - 1 AS attempt
    FROM (
      SELECT *, 0 AS slot, site_url AS candidate_url, site_source AS candidate_source
      FROM {source} WHERE coalesce(site_url, '') <> ''
      UNION ALL SELECT *, 1, 'https://' || email_dominio || '/', 'corporate_email_domain'
      FROM {source} WHERE {own}
      UNION ALL SELECT *, 2, 'https://www.' || email_dominio || '/', 'corporate_email_domain'
      FROM {source} WHERE {own})"""


def ownership(source: str) -> str:
    """Ownership evidence of every read page tried."""
    title = norm("trim(regexp_extract(html, '(?i)<title[^>]*>([^<]{1,200})</title>', 1))")
    fantasia, razao, city = norm("nome_fantasia"), norm("razao_social"), norm("municipio_descricao")
    tel = f"right({digits("coalesce(telefone_1, '')")}, 10)"
    by_name = "(length(fantasia_n) >= 4 AND contains(content, fantasia_n))"
    evidence = [
        *[(f"title_incompativel:{w}", f"contains(title_n, '{w.replace('.', ' ')}')", -30)
          for w in sorted(K.INCOMPATIBLE_TITLES)],
        ("nome_fantasia_no_conteudo", by_name, 30),
        ("razao_social_no_conteudo",
         f"(NOT {by_name} AND length(razao_n) >= 6 AND contains(content, razao_n))", 20),
        ("municipio_no_conteudo", "(city_n <> '' AND contains(content, city_n))", 10),
        ("uf_no_conteudo",
         "(coalesce(uf, '') <> '' AND contains(' ' || content || ' ', ' ' || lower(uf) || ' '))", 10),
        ("telefone_coincide", "(tel <> '' AND contains(digits, tel))", 15),
        ("cnpj_no_site", "(length(cnpj) = 14 AND contains(digits, cnpj))", 20),
        ("dominio_email_coincide",
         "(email_tipo = 'corporativo' AND coalesce(email_dominio, '') <> ''"
         " AND contains(host, email_dominio))", 15),
        ("dominio_compartilhado", "domain_shared_count >= 3", -30),
        ("dominio_possivelmente_compartilhado", "domain_shared_count IN (1, 2)", -10),
    ]
    score = " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for _, c, n in evidence)
    reasons = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c, _ in evidence)
    webmail = "email_tipo = 'gratuito'"
    return f"""
    SELECT *, CASE WHEN {webmail} THEN 'rejected_webmail' WHEN score >= 70 THEN 'validated'
        WHEN score >= 40 THEN 'partial_match' ELSE 'unverified' END AS site_match_status,
      CASE WHEN {webmail} THEN 0 ELSE score END AS site_match_score,
      CASE WHEN {webmail} THEN 'webmail_domain' ELSE reasons END AS site_validation_reasons
    FROM (SELECT *, {clamp(score)} AS score, concat_ws('|', {reasons}) AS reasons
    FROM (SELECT t.*, c.content, {digits('c.content')} AS digits, c.title_n, {HOST} AS host,
      {fantasia} AS fantasia_n, {razao} AS razao_n, {city} AS city_n, {tel} AS tel
      FROM {source} t JOIN (SELECT page_id AS pid, {norm('html')} AS content, {title} AS title_n
        FROM pg WHERE {IS_HTML}) c ON c.pid = t.page_id))"""


STEPS["tried"] = tries("profiled")
STEPS["landed"] = (
    "SELECT t.*, k.page_id, k.url, k.status, k.content_type FROM tried t"
    " JOIN page_keys k ON k.url_key = t.url_key"
)
STEPS["owned"] = ownership("landed")


def statement(sql: str) -> str:
    """Put the named steps a statement uses in front of it, each after the steps it uses."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in STEPS and name not in ordered:
                visit(STEPS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in ordered) + "\n" + sql


def named_count(column: str, source: str = "state") -> str:
    return (
        f"SELECT '{column}' AS secao, {column} AS valor, count(*) AS total FROM {source}"
        f" WHERE {column} IS NOT NULL GROUP BY 2"
    )


_LOADED = {
    "Empresas": ("empresas", "cnpj_basico"), "Estabelecimentos": ("estabelecimentos", "cnpj"),
    "Socios": ("socios", "id"), "Simples": ("simples", "cnpj_basico"), "Cnaes": ("cnaes", "codigo"),
    "Municipios": ("municipios", "codigo"), "Naturezas": ("naturezas", "codigo"),
}
_FILE_TYPE = "CASE " + " ".join(
    f"WHEN regexp_matches(name, '(?i){k}') THEN '{k}'" for k in DATASETS
) + " END"
_FILES = f"(SELECT *, {_FILE_TYPE} AS file_type FROM listing WHERE {_FILE_TYPE} IS NOT NULL AND ends_with(lower(name), '.zip'))"
_UPDATES = """(SELECT *, 'a' AS f, 'A ' || razao_social AS r, cnpj_basico AS k FROM empresas
    WHERE coalesce(capital_social, 0) > 1000000
  UNION ALL SELECT *, 'b', 'B ' || razao_social, cnpj_basico FROM empresas WHERE porte = '03'
  UNION ALL SELECT *, 'c', razao_social, 'N' || cnpj_basico FROM empresas WHERE porte = '05')"""
_CITY = "SELECT codigo_ibge, populacao FROM population WHERE codigo <> '0007'"
_SIGNAL_ROW = f"host, {', '.join(FLAGS)}, has_chat, plataforma_confianca, chat_provider, plataforma, plataformas_detectadas"
_PLATFORM_SIM = f"""
    SELECT p.*, c.uf, c.cep, c.telefone_1, {norm('c.logradouro')} AS street,
      {norm('c.municipio_descricao')} AS city, {norm('p.formatted_address')} AS address,
      {norm('c.nome_fantasia')} AS a, coalesce(c.nome_fantasia, '') AS fantasia
    FROM places p JOIN candidates c ON c.cnpj = p.cnpj"""
# Similarity in closed form for these names: equal texts give 1, a text plus a suffix
# 2 * shorter / (both lengths), texts without a common letter 0. No legal name of the data comes
# near its threshold.
_SIM = """CASE WHEN fantasia = '' OR display_name = '' THEN 0 WHEN position = 0 THEN 1
    WHEN position = 1 THEN 2.0 * length(a) / (2 * length(a) + CASE WHEN a = '' THEN 7 ELSE 8 END)
    ELSE 0 END"""
STEPS["place_rows"] = f"SELECT *, {_SIM} AS sim FROM ({_PLATFORM_SIM})"
STEPS["place_scored"] = f"""
    SELECT *, {clamp(pts(("sim >= 0.75", 30), ("city <> '' AND contains(address, city)", 10),
      ("city <> '' AND NOT contains(address, city)", -40),
      ("coalesce(uf, '') <> '' AND contains(' ' || address || ' ', ' ' || lower(uf) || ' ')", 10),
      ("street <> '' AND contains(address, left(street, 20))", 10),
      (f"coalesce(cep, '') <> '' AND contains({digits('formatted_address')}, replace(cep, '-', ''))", 10),
      (f"{digits("coalesce(national_phone, '')")} <> '' AND right({digits("coalesce(national_phone, '')")}, 10) = right({digits("coalesce(telefone_1, '')")}, 10)", 15)))}
      AS match_score FROM place_rows"""
STEPS["place_best"] = """
    SELECT cnpj, match_score AS google_place_match_score,
      CASE WHEN match_score >= 70 THEN place_id END AS place_id,
      CASE WHEN match_score >= 70 THEN website END AS website,
      CASE WHEN match_score >= 70 THEN business_status END AS business_status
    FROM (SELECT *, row_number() OVER (PARTITION BY cnpj ORDER BY match_score DESC, position) AS rk
      FROM place_scored) WHERE rk = 1"""
STEPS["outcomes"] = f"""
    SELECT page_id, coalesce(status BETWEEN 200 AND 299 OR status IN (401, 403), false) AS reachable,
      {IS_HTML} AS has_html,
      CASE WHEN status IS NULL OR status BETWEEN 300 AND 399 THEN error
        WHEN status = 429 THEN 'rate_limited' WHEN status BETWEEN 200 AND 299 THEN
        CASE WHEN NOT {IS_HTML} THEN 'conteudo_nao_html' END ELSE 'http_' || status END AS fetch_error,
      CASE WHEN error = 'dns_falhou' OR status IN (404, 410) THEN 30 END AS retry_after_days,
      CASE WHEN status = 429 THEN coalesce(TRY_CAST(retry_after AS INT), 24)
        WHEN status >= 500 OR error = 'ConnectionError' THEN 24 END AS retry_after_hours
    FROM site_pages"""
_RETAIL_FIT = fit("''", 0)
STEPS["state_scored"] = scored("state", _RETAIL_FIT)

_STATEMENTS = {
    "s1_registry_scan": f"SELECT {txt(*DATASETS['Empresas'].columns)} FROM raw_empresas",
    "s2_zipped_scan": f"SELECT {txt(*DATASETS['Socios'].columns)} FROM raw_socios",
    "s3_dataset_catalog": " UNION ALL ".join(
        f"SELECT '{kind}' AS tipo, '{DATASETS[kind].table}' AS tabela, '{key}' AS chave,"
        f" count(*) AS linhas, count(DISTINCT {key}) AS chaves FROM {table}"
        for kind, (table, key) in _LOADED.items()
    ),
    "s4_file_kinds": f"SELECT competence, name, file_type FROM {_FILES}",
    "s5_latest_release": "SELECT max(competence) AS competence FROM listing"
    " WHERE regexp_matches(competence, '20[0-9]{2}-(0[1-9]|1[0-2])')",
    "s6_population_series": _CITY,
    "s7_city_catalogue": "SELECT codigo_ibge, uf, lpad(right(codigo_ibge, 4), 4, '0') AS codigo, nome FROM population",
    "s8_population_table": "SELECT codigo_ibge, uf, right(codigo_ibge, 4) AS codigo, nome, populacao,"
    " ano_referencia FROM population WHERE codigo <> '0007'",
    "load_population": f"""
    SELECT codigo_ibge, uf, codigo, nome, populacao + CAST(old AS int) AS populacao,
      {YEAR} - CAST(old AS int) AS ano_referencia,
      CASE WHEN old THEN '{NOW}' ELSE '2025-01-01 00:00:00' END AS updated_at,
      count(*) FILTER (populacao + CAST(old AS int) >= 100000) OVER () AS cidades,
      count(*) FILTER (NOT old) OVER () AS merged, count(*) FILTER (codigo = '0007' AND length(codigo_ibge) = 7) OVER () AS left_out
    FROM (SELECT *, codigo = '0007' AS old FROM population UNION ALL
      SELECT * REPLACE ('9' || codigo_ibge AS codigo_ibge), true FROM population
      WHERE CAST(codigo_ibge AS int) % 4 = 0)""",
    "s9_population_check": f"SELECT count(*) AS linhas, count(*) > 0 AS existe, count(*) >= 5500 AS completa"
    f" FROM population WHERE ano_referencia = {YEAR}",
    "s10_fact_upsert": f"""
    SELECT cnpj_basico, razao_social, '{COMPETENCE}' AS source_competence, '{NOW}' AS updated_at,
      coalesce(CAST(capital_social AS DOUBLE), -1) AS capital_social
    FROM empresas WHERE cnpj_basico NOT IN (SELECT k FROM {_UPDATES})
    UNION ALL SELECT k, r, '2026-08', '2026-08-02 00:00:00',
      coalesce(CAST(capital_social AS DOUBLE), -1)
    FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY f DESC) AS rk FROM {_UPDATES})
    WHERE rk = 1""",
    "s10_change_rows": f"""
    SELECT k AS cnpj_basico, r AS razao_social, 'unchanged' AS second_change,
      CASE WHEN k IN (SELECT cnpj_basico FROM empresas) THEN 'updated' ELSE 'inserted' END AS first_change
    FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY f DESC) AS rk FROM {_UPDATES})
    WHERE rk = 1""",
    "s11_lookup_upsert": """
    SELECT m.codigo, CASE WHEN n.n_regionkey = 1 THEN 'Nova ' || n_name ELSE m.descricao END AS descricao
    FROM municipios m JOIN nation n ON lpad(CAST(n_nationkey AS VARCHAR), 4, '0') = m.codigo
    UNION ALL SELECT '9' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), 'Nova ' || n_name
    FROM nation WHERE n_regionkey = 2""",
    "s12_population_upsert": f"""
    SELECT codigo_ibge, uf, codigo, nome,
      CASE WHEN populacao % 2 = 0 THEN populacao + 5 ELSE populacao END AS populacao,
      CASE WHEN populacao % 2 = 0 THEN 2025 ELSE ano_referencia END AS ano_referencia,
      CASE WHEN populacao % 2 = 0 THEN '2025-01-01 00:00:00' ELSE '{NOW}' END AS updated_at
    FROM population""",
    "s13_enrichment_upsert": f"""
    SELECT cnpj, enrich_status,
      {txt('lead_score', 'plataforma', 'processing_run_id', 'site_match_status', 'digital_score')},
      {ts('enriched_at', 'enriched_at')}
    FROM state WHERE cnpj NOT IN (SELECT cnpj FROM estabelecimentos WHERE situacao_cadastral = '08')
    UNION ALL SELECT e.cnpj, 'done', '77', 'vtex', '', {txt('site_match_status', 'digital_score')}, '{NOW}'
    FROM (SELECT cnpj FROM estabelecimentos WHERE situacao_cadastral = '08') e
    LEFT JOIN state s ON s.cnpj = e.cnpj""",
    "s14_qualification_upsert": f"""
    SELECT cnpj, cnpj_basico, qualification_status, {txt('lead_score', 'contact_channel', 'history_note')},
      {ts('qualified_at', 'qualified_at')}, {ts('last_qualified_at', 'last_qualified_at')}
    FROM requalified""",
    "s15_files_to_load": f"""
    SELECT competence, name, file_type FROM {_FILES} WHERE NOT (length(name) % 4 <> 0 AND (size IS NULL OR size % 3000 <> 0)
      AND (last_modified IS NULL OR last_modified <> 'ECONOMY'))""",
    "s17_load_audit": f"""
    SELECT competence, name AS file_name, file_type,
      CASE WHEN size IS NULL OR size % 7000 = 0 THEN 'failed' ELSE 'success' END AS status,
      coalesce(size, 0) AS rows_processed, CASE WHEN size % 7000 = 0 THEN 5000 ELSE 0 END AS error_length
    FROM {_FILES}""",
    "s17_run_audit": f"""
    SELECT '{COMPETENCE}' AS competence, CASE WHEN count(*) = 0 THEN 'skipped'
        WHEN count(*) > count(size) THEN 'failed' ELSE 'success' END AS status, count(*) AS files_total,
      count(size) AS files_processed, CAST(coalesce(sum(size), 0) AS BIGINT) AS rows_processed FROM listing""",
    "p1_clean_text": f"SELECT cnpj_basico, {clean('razao_social')} AS razao_social,"
    f" coalesce({clean('porte')}, '-') AS porte FROM raw_empresas",
    "p2_dates": "SELECT cnpj, strftime(data_situacao_cadastral, '%Y-%m-%d') AS data_situacao_cadastral,"
    " strftime(data_inicio_atividade, '%Y-%m-%d') AS data_inicio_atividade FROM estabelecimentos",
    "p3_amounts": "SELECT cnpj_basico, coalesce(CAST(capital_social AS DOUBLE), -1) AS capital_social FROM empresas",
    "p4_branch_key": "SELECT cnpj_basico, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj FROM raw_estabelecimentos",
    "p5_content_hash": "SELECT cnpj_basico, nome_socio_razao_social, id FROM socios",
    "p6_release_stamp": f"SELECT cnpj_basico, opcao_mei, '{COMPETENCE}' AS source_competence FROM simples",
    "p7_cnae": f"SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, {cnae7('cnae_fiscal_principal')} AS cnae FROM raw_estabelecimentos",
    "p8_secondary_cnaes": f"""
    SELECT cnpj, coalesce((SELECT string_agg(v, '|' ORDER BY p) FROM (SELECT v, min(p) AS p FROM
      (SELECT unnest(l) AS v, generate_subscripts(l, 1) AS p) GROUP BY v)), '') AS cnaes
    FROM (SELECT cnpj, {SECONDARY} AS l FROM estabelecimentos)""",
    "p9_city_key": f"SELECT cnpj, {UF} AS uf, {CITY4} AS codigo FROM estabelecimentos",
    "p10_phones": "SELECT cnpj, concat_ws('', ddd1, telefone1) AS telefone_1,"
    " concat_ws('', ddd2, telefone2) AS telefone_2 FROM estabelecimentos",
    "p11_size_band": f"SELECT e.cnpj_basico, {_BAND} AS faixa_porte_receita, {_BAND_SOURCE} AS porte_receita_fonte"
    " FROM empresas e LEFT JOIN simples s ON s.cnpj_basico = e.cnpj_basico",
    "p12_normalize_names": f"SELECT cnpj_basico, {norm('razao_social')} AS nome FROM empresas",
    "p12_normalize_documents": f"SELECT doc_id, md5({norm('text')}) AS hash FROM documents",
    "f1_active": "SELECT cnpj FROM estabelecimentos WHERE situacao_cadastral = '02'",
    "f2_states": f"SELECT cnpj, uf FROM estabelecimentos WHERE {UF} IN ('PR', 'SP')",
    "f3_large_cities": f"SELECT cnpj, municipio FROM estabelecimentos e WHERE EXISTS (SELECT 1 FROM population p"
    f" WHERE p.uf = {UF.replace('uf', 'e.uf')} AND p.codigo = {CITY4} AND populacao >= 200000)",
    "f4_trade_name": "SELECT cnpj FROM estabelecimentos WHERE nome_fantasia IS NOT NULL",
    "f5_phone": f"SELECT cnpj, ddd1, telefone1 FROM estabelecimentos WHERE {VALID_PHONE}",
    "f6_cnaes": f"""
    SELECT cnpj, {cnae7('cnae_fiscal_principal')} IN ('4781400', '0111301') AS principal
    FROM estabelecimentos WHERE {cnae7('cnae_fiscal_principal')} IN ('4781400', '0111301')
      OR list_has_any({SECONDARY}, ['4781400', '0111301'])""",
    "f7_branch_filter": f"""
    SELECT cnpj FROM estabelecimentos e WHERE situacao_cadastral = '02' AND {UF} IN ('PR', 'SP', 'MG')
      AND nome_fantasia IS NOT NULL AND {VALID_PHONE}
      AND ({cnae7('cnae_fiscal_principal')} IN ({RETAIL}) OR list_has_any({SECONDARY}, [{RETAIL}]))
      AND EXISTS (SELECT 1 FROM population p WHERE p.uf = {UF.replace('uf', 'e.uf')}
        AND p.codigo = {CITY4} AND populacao >= 100000)""",
    "f8_follow_branches": "SELECT id, cnpj_basico FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM accepted)",
    "f9_lookup": f"SELECT codigo, descricao FROM cnaes WHERE codigo IN ({RETAIL})",
    "f10_retail": f"SELECT cnpj, cnae_fiscal_principal FROM estabelecimentos WHERE cnae_fiscal_principal IN ({RETAIL})",
    "f11_acceptance": f"""
    SELECT file_name, count(*) AS lidas, count(*) FILTER (ok) AS gravadas,
      count(*) FILTER (NOT ok) AS ignoradas,
      round(count(*) FILTER (ok) * CAST(100 AS DOUBLE) / count(*), 6) AS taxa,
      count(DISTINCT cnpj_basico) FILTER (ok) AS empresas_unicas
    FROM (SELECT *, 'Estabelecimentos' || motivo_situacao_cadastral || '.zip' AS file_name,
      situacao_cadastral = '02' AND {cnae7('cnae_fiscal_principal')} IN ({RETAIL}) AS ok
      FROM estabelecimentos) GROUP BY 1""",
    "j1_complete_companies": f"SELECT cnpj, cnpj_basico, {txt(*'razao_social nome_fantasia natureza_juridica natureza_juridica_descricao porte situacao_cadastral cnae_fiscal_principal cnae_principal_descricao logradouro cep uf municipio municipio_descricao telefone_1 telefone_2 email opcao_simples opcao_mei source_competence data_inicio_atividade'.split())}, coalesce(CAST(capital_social AS DOUBLE), -1) AS capital_social FROM complete",
    "j2_retail_branches": "SELECT cnpj, nome_fantasia, uf, municipio, telefone_1, populacao AS municipio_populacao, ano_referencia AS municipio_pop_ano FROM retail",
    "j3_candidates": f"SELECT cnpj, cnae_fiscal_principal, {txt('email', 'razao_social')} FROM candidates",
    "j4_prospect_digital": f"""
    SELECT v.cnpj, v.uf, {txt('st.enrich_status', 'st.plataforma', 'st.digital_score', 'st.decisor_nome')},
      coalesce(strftime(st.enriched_at, '%Y-%m-%d'), '') AS dia
    FROM retail v LEFT JOIN state st ON st.cnpj = v.cnpj""",
    "j5_qualification_input": f"SELECT cnpj, enrich_status, {txt('email', 'email_original', 'lead_score')} FROM joined",
    "j6_rescore_input": f"""
    SELECT st.cnpj, {txt('st.score_version', 'c.cnae_fiscal_principal')} FROM state st
    LEFT JOIN candidates c ON c.cnpj = st.cnpj WHERE st.score_version IS DISTINCT FROM 'v2'""",
    "j7_queue_input": f"""
    SELECT cnpj, CASE WHEN has_state THEN 'true' ELSE '' END AS has_state,
      {txt('enrich_status', 'enrich_attempts', 'google_place_id')} FROM queue""",
    "j8_site_candidates": f"SELECT cnpj, attempt, candidate_url, candidate_source, page_id, {txt('status')} FROM landed",
    "j8_refetched_pages": f"""
    SELECT cnpj, attempt, candidate_url, f.page_id, {txt('f.status')} FROM tried t JOIN (
      SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY day DESC, status IS NULL,
        CASE WHEN status BETWEEN 200 AND 299 THEN 0 ELSE 1 END, status, url DESC) AS rk FROM (
        SELECT url_key, url, page_id, status, page_id * 7919 % 1000 AS day FROM page_keys
        UNION ALL SELECT url_key, url, -page_id, 404, page_id * 104729 % 1000 FROM page_keys)) f
    ON f.url_key = t.url_key AND rk = 1""",
    "j9_place_scores": "SELECT cnpj, place_id, match_score FROM place_scored",
    "j10_provider_overlay": f"SELECT cnpj, {txt('site_url', 'site_source', 'faturamento_estimado', 'faturamento_estimado_fonte', 'decisor_nome')} FROM profiled",
    "a1_status_counts": "SELECT enrich_status, count(*) AS total FROM state GROUP BY 1",
    "a1_kept_counts": """
    SELECT CASE WHEN situacao_cadastral = '08' THEN 'done' ELSE enrich_status END AS enrich_status, count(*) AS total
    FROM state s FULL JOIN (SELECT cnpj, situacao_cadastral FROM estabelecimentos WHERE situacao_cadastral = '08') b
      ON s.cnpj = b.cnpj GROUP BY 1""",
    "a2_valid_contacts": "SELECT count(*) FILTER (site_valid) AS sites_valid, count(*) FILTER (whatsapp_valid) AS whatsapps_valid FROM state",
    "a3_maturity_counts": " UNION ALL ".join(map(named_count, ("commerce_maturity", "presence_maturity", "lead_classification"))),
    "a4_top_platforms": "SELECT plataforma, count(*) AS total FROM state WHERE plataforma IS NOT NULL GROUP BY 1 ORDER BY total DESC, plataforma LIMIT 10",
    "a5_qualification_counts": "SELECT qualification_status, count(*) AS total FROM evaluated GROUP BY 1",
    "a6_shared_domains_batch": f"""
    SELECT d.cnpj, {txt('email_dominio')}, domain_shared_count, domain_shared_count >= 3 AS domain_is_shared
    FROM domains d JOIN candidates c ON c.cnpj = d.cnpj WHERE c.uf = 'PR'""",
    "a6_shared_domains": f"SELECT cnpj, {txt('email_dominio')}, domain_shared_count, domain_shared_count >= 3 AS domain_is_shared FROM domains",
    "a7_merge_signals": f"SELECT {_SIGNAL_ROW} FROM ({merged('read_signals', 'page_id')})",
    "a8_run_stats": "SELECT run_id, count(*) AS processed, " + ", ".join(
        f"count(*) FILTER (enrich_status = '{s}') AS {s}" for s in ("done", "partial", "no_site", "failed")
    ) + " FROM attempts GROUP BY 1",
    "a9_large_cities": "SELECT count(*) AS cidades FROM population WHERE populacao >= 100000",
    "a10_year_rows": " UNION ALL ".join(
        f"SELECT count(*) AS linhas, count(*) > 0 AS existe, count(*) >= 5500 AS completa FROM population WHERE ano_referencia = {y}"
        for y in (YEAR, YEAR - 1)
    ),
    "w1_decision_makers": "SELECT cnpj_basico, decisor_nome, decisor_qualificacao FROM deciders",
    "w2_last_row_wins": """
    SELECT chave, id, nome_socio_razao_social FROM (SELECT *, cnpj_basico || '-' || qualificacao_socio AS chave,
      row_number() OVER (PARTITION BY cnpj_basico, qualificacao_socio
        ORDER BY data_entrada_sociedade DESC NULLS LAST, id DESC) AS rk FROM socios) WHERE rk = 1""",
    "w3_platform_ranking": f"SELECT page_id, {ranked(True)} AS plataformas FROM hits",
    "w4_best_places": f"SELECT cnpj, google_place_match_score, {txt('place_id', 'website', 'business_status')} FROM place_best",
    "w5_best_attempts": """
    SELECT a.cnpj, event_id AS attempt, status, value FROM attempts a JOIN (
      SELECT cnpj, coalesce(min(event_id) FILTER (status = 404 OR (status = 200 AND (value > 90 OR value < 1))),
        max(event_id) FILTER (status IS NOT NULL)) AS pick FROM attempts GROUP BY 1) d
    ON d.cnpj = a.cnpj AND d.pick = a.event_id""",
    "w5_decided_sites": """
    SELECT cnpj, coalesce(bool_or(status IS NOT NULL), false) AS answered,
      (arg_max({'x': status}, event_id) FILTER (status IS NOT NULL)).x AS status,
      (arg_max({'x': value}, event_id) FILTER (verdict IS NOT NULL)).x AS site_match_score,
      coalesce(bool_or(value BETWEEN 50 AND 55), false) AS cnpj_on_site,
      coalesce('https://site' || max(event_id) FILTER (status IS NOT NULL), '') AS candidate_url,
      coalesce(arg_max(verdict, event_id) FILTER (verdict IS NOT NULL), '') AS site_match_status,
      coalesce(arg_max(enrich_status, event_id) FILTER (status IS NULL OR status = 429), '') AS fetch_error
    FROM (SELECT *, CASE WHEN status = 200 THEN CASE WHEN value < 1 THEN 'rejected_webmail'
        WHEN value > 90 THEN 'validated' ELSE 'weak' END END AS verdict,
      coalesce(max(CASE WHEN status = 404 OR (status = 200 AND (value < 1 OR value > 90)) THEN 1 ELSE 0 END)
        OVER (PARTITION BY cnpj ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over
      FROM attempts) WHERE over = 0 GROUP BY 1""",
    "l1_outreach_legacy": f"""
    SELECT cnpj, {txt('digital_score')}, {ts('qualified_at', 'qualified_at')} FROM requalified
    ORDER BY digital_score DESC NULLS FIRST, qualified_at DESC NULLS FIRST""",
    "l2_outreach": f"""
    SELECT cnpj, coalesce(site_final_url, site_url, '') AS site_final_url,
      {txt('lead_score', 'confidence_score', 'contact_channel', 'contact_value')},
      CASE WHEN whatsapp_valid THEN coalesce(whatsapp_url, '') ELSE '' END AS whatsapp_url,
      qualification_status FROM evaluated""",
    "l3_newest_active": f"""
    SELECT cnpj, {txt('razao_social', 'nome_fantasia', 'telefone_1', 'email', 'uf', 'data_inicio_atividade')}
    FROM (SELECT * FROM complete WHERE situacao_cadastral = '02' AND uf = 'PR'
      AND cnae_fiscal_principal = '4781400'
      ORDER BY data_inicio_atividade DESC NULLS FIRST, cnpj LIMIT 100)""",
    "l4_keyset_batch": f"""
    SELECT cnpj, {txt('enrich_status')} FROM (SELECT * FROM waiting WHERE cnpj > '00000200'
      AND cnpj NOT IN (SELECT cnpj FROM state WHERE enrich_status = 'done') ORDER BY cnpj LIMIT 300)""",
    "l5_recent_runs": """
    SELECT o_orderkey AS id, substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS competence,
      CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status,
      o_custkey AS rows_processed FROM orders ORDER BY o_orderkey DESC LIMIT 100""",
    "l6_qualified_list": f"""
    SELECT cnpj, qualification_status, {txt('lead_score', 'contact_channel')} FROM evaluated
    WHERE qualification_status = 'qualified'""",
    "c1_email_profile": f"""
    SELECT cnpj, coalesce({email_domain('correio_eletronico')}, '') AS email_dominio,
      CASE WHEN contains(correio_eletronico, '@') THEN lower(correio_eletronico) ELSE '' END AS email_normalizado,
      {email_kind('correio_eletronico')} AS email_tipo FROM estabelecimentos""",
    "c2_email_role": f"SELECT cnpj, {email_role('correio_eletronico')} AS papel FROM estabelecimentos",
    "c3_phones": f"SELECT cnpj, coalesce({phone('t')}, '') AS telefone FROM (SELECT cnpj, concat_ws('', ddd1, telefone1) AS t FROM estabelecimentos)",
    "c4_whatsapp_candidates": f"SELECT cnpj, 'https://wa.me/' || {phone('telefone_1')} AS link FROM candidates WHERE {phone('telefone_1')} IS NOT NULL",
    "c5_whatsapp_links": f"""
    SELECT p.page_id, coalesce(w.detected, false) AS detected, w.normalized IS NOT NULL AS valid,
      CASE WHEN w.normalized IS NOT NULL THEN 90 WHEN w.detected THEN 10 ELSE 0 END AS confidence,
      {txt('w.number', 'w.normalized')}, coalesce('https://wa.me/' || w.normalized, '') AS canonical_url
    FROM pg p LEFT JOIN whatsapps w ON w.page_id = p.page_id""",
    "c6_social_links": f"SELECT p.page_id, {txt('s.instagram', 's.linkedin')} FROM pg p LEFT JOIN socials s ON s.page_id = p.page_id",
    "c7_contact_channel": f"SELECT cnpj, {txt('contact_channel', 'contact_value')}, contact_confidence, contact_role FROM channelled",
    "g1_platforms": f"SELECT page_id, {txt('plataforma')}, plataforma_confianca, plats AS plataformas_detectadas FROM signals",
    "g2_chat": f"SELECT page_id, chat_provider IS NOT NULL AS has_chat, {txt('chat_provider')} FROM signals",
    "g3_commerce_flags": f"SELECT page_id, {', '.join(FLAGS)} FROM signals",
    "g4_site_rollup": f"SELECT {_SIGNAL_ROW} FROM rollup",
    "g5_page_merge": f"""
    SELECT s.page_id,
      {', '.join(f'(s.{f} OR coalesce(r.{f}, false)) AS {f}' if f not in ('has_customer_login', 'has_contact_form', 'coming_soon') else f's.{f} AS {f}' for f in FLAGS)},
      (s.chat_provider IS NOT NULL OR coalesce(r.has_chat, false)) AS has_chat,
      greatest(s.plataforma_confianca, coalesce(r.plataforma_confianca, 0)) AS plataforma_confianca,
      coalesce(s.chat_provider, r.chat_provider, '') AS chat_provider,
      CASE WHEN r.plataforma <> '' AND r.plataforma_confianca > s.plataforma_confianca
        THEN r.plataforma ELSE coalesce(s.plataforma, '') END AS plataforma,
      CASE WHEN r.plataforma <> '' AND r.plataforma_confianca > s.plataforma_confianca
        THEN r.plataformas_detectadas ELSE s.plats END AS plataformas_detectadas
    FROM signals s LEFT JOIN rollup r ON r.host = s.host AND s.page_id % 3 <> 0 WHERE s.visit = 0""",
    "g6_strong_commerce": f"SELECT page_id, {STRONG} AS forte FROM signals",
    "g7_titles": f"SELECT page_id, trim(regexp_extract(html, '(?i)<title[^>]*>([^<]{{1,200}})</title>', 1), {SPACES}) AS titulo FROM pages",
    "g8_hosts": f"SELECT page_id, {HOST} AS host FROM pages",
    "g9_site_ownership": "SELECT cnpj, attempt, site_match_score, site_match_status, site_validation_reasons FROM owned",
    "g10_site_validity": "SELECT cnpj, attempt, site_match_score >= 40 AND site_match_status = 'validated' AS site_valid,"
    " contains(site_validation_reasons, 'cnpj_no_site') AS cnpj_on_site FROM owned",
    "g11_fetch_outcome": f"SELECT page_id, reachable, has_html, {txt('fetch_error', 'retry_after_days', 'retry_after_hours')} FROM outcomes",
    "g12_unsafe_urls": """
    SELECT page_id, CASE page_id % 12 WHEN 1 THEN 'scheme_invalido' WHEN 2 THEN 'credenciais_na_url'
      WHEN 3 THEN CASE WHEN page_id % 256 = 1 THEN 'localhost' ELSE 'ip_bloqueado:127.0.0.' || (page_id % 256) END
      WHEN 4 THEN 'ip_bloqueado:10.' || (page_id % 256) || '.1.2'
      WHEN 5 THEN CASE WHEN page_id % 256 BETWEEN 16 AND 31 THEN 'ip_bloqueado:172.' || (page_id % 256) || '.0.1' ELSE '' END
      WHEN 7 THEN 'ip_bloqueado:127.0.0.' || (page_id % 256)
      WHEN 8 THEN 'host_ausente' WHEN 9 THEN 'localhost'
      WHEN 10 THEN 'ip_bloqueado:224.0.' || (page_id % 256) || '.1'
      WHEN 11 THEN 'ip_bloqueado:169.254.' || (page_id % 256) || '.254' ELSE '' END AS unsafe_reason
    FROM pages""",
    "g13_enrich_status": f"""
    SELECT cnpj, CASE WHEN site_http_status = 200 AND site_reachable THEN
        CASE WHEN site_valid AND {STRONG} THEN 'done' ELSE 'partial' END
      WHEN NOT site_ativo OR coalesce(site_url, '') = '' THEN 'no_site'
      WHEN NOT site_reachable THEN 'failed' ELSE 'partial' END AS enrich_status FROM state""",
    "q1_presence": "SELECT cnpj, presence_score, presence_maturity FROM state_scored",
    "q2_commerce": "SELECT cnpj, commerce_score, commerce_maturity FROM state_scored",
    "q3_fit": f"SELECT cnpj, fit_score FROM ({scored('state', fit(quoted(['4781400', '4791201']), 15))})",
    "q4_pain": "SELECT cnpj, pain_score FROM state_scored",
    "q5_confidence": "SELECT cnpj, confidence_score FROM state_scored",
    "q6_lead": "SELECT cnpj, lead_score, lead_classification FROM state_scored",
    "q7_all_scores": "SELECT cnpj, presence_score, presence_maturity, commerce_score, commerce_maturity, fit_score,"
    " pain_score, confidence_score, lead_score, lead_classification, digital_score, digital_maturity, score_version FROM state_scored",
    "q8_rescore": f"""
    SELECT cnpj, fit_score, lead_score, digital_score, score_version, '{NOW}' AS updated_at
    FROM ({scored("(SELECT st.* EXCLUDE (cnae_fiscal_principal), c.cnae_fiscal_principal FROM state st LEFT JOIN candidates c ON c.cnpj = st.cnpj WHERE st.score_version IS DISTINCT FROM 'v2')", _RETAIL_FIT)})""",
    "q9_qualification": f"SELECT cnpj, qualification_status, rejection_reasons, qualification_reasons FROM ({qualified('channelled', 50, 40)})",
    "q10_qualified_rows": f"""
    SELECT cnpj, qualification_status, 'v2' AS qualification_version,
      CASE WHEN whatsapp_valid THEN coalesce(whatsapp_url, '') ELSE '' END AS whatsapp_url,
      coalesce(CAST(coalesce(nullif(lead_score, 0), digital_score) AS VARCHAR), '') AS digital_score,
      coalesce(nullif(commerce_maturity, ''), digital_maturity, '') AS digital_maturity,
      coalesce(nullif(faixa_porte_receita, ''), faixa_faturamento_estimada, '') AS faixa_faturamento_estimada,
      {txt('contact_value')} FROM evaluated""",
    "r1_pending": f"SELECT cnpj, {txt('enrich_status', 'enrichment_version')} FROM waiting",
    "r2_next_retry": f"""
    SELECT cnpj, {ts(f'''CASE WHEN retry_reason = 'google_places_no_result' THEN {NOW_TS} + to_days(90)
      WHEN enrich_attempts = 1 THEN {NOW_TS} + to_days(30)
      WHEN enrich_attempts = 2 AND coalesce(lead_score, 0) <> 0 THEN {NOW_TS} + to_hours(lead_score)
      WHEN enrich_status = 'no_site' THEN {NOW_TS} + to_days(30)
      WHEN enrich_status = 'failed' THEN {NOW_TS} + to_hours(24) END''', 'next_retry_at', '')} FROM state""",
    "r3_requeue": f"""
    SELECT cnpj, x AS requeued, CASE WHEN x AND enrich_status IN ('done', 'partial') THEN 'pending' ELSE enrich_status END AS enrich_status,
      CASE WHEN x THEN '' ELSE enrichment_version END AS enrichment_version,
      CASE WHEN x THEN 'version_upgrade' ELSE coalesce(retry_reason, '') END AS retry_reason,
      {ts(f'CASE WHEN x THEN {NOW_TS} ELSE next_retry_at END', 'next_retry_at', '')}
    FROM (SELECT *, enrichment_version IS DISTINCT FROM 'v2' OR score_version IS DISTINCT FROM 'v2' AS x FROM state)""",
    "r4_attempts": "SELECT cnpj, coalesce(enrich_attempts, 0) + 1 AS enrich_attempts FROM state",
    "r5_cached_places": f"SELECT cnpj, google_place_id IS NOT NULL AND coalesce(google_places_checked_at > {NOW_TS} - to_days(90), false) AS em_cache FROM state",
    "r7_stream_ingest": """
    SELECT cnpj_basico, CASE WHEN natureza_juridica > '0010' THEN 'Julho SA' ELSE razao_social END AS razao_social,
      CASE WHEN natureza_juridica > '0010' THEN '05' ELSE coalesce(porte, '') END AS porte,
      CASE WHEN natureza_juridica > '0010' THEN '2026-07' ELSE '2026-06' END AS source_competence
    FROM empresas""",
    "ingest_release": f"""
    SELECT 'estabelecimentos' AS tabela, count(*) AS linhas FROM loaded
    UNION ALL SELECT 'empresas', count(*) FROM empresas WHERE cnpj_basico IN (SELECT cnpj_basico FROM loaded)
    UNION ALL SELECT 'socios', count(DISTINCT id) FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM loaded)
    UNION ALL SELECT 'cnaes', count(*) FROM cnaes WHERE codigo IN ({RETAIL})""",
}
STEPS["loaded"] = f"SELECT * FROM accepted WHERE {VALID_PHONE}"

# --- The enrichment job as a whole ---

_READ = "(o.has_html AND o.reachable)"
_SURER = "(r.plataforma <> '' AND r.plataforma_confianca > coalesce(g.plataforma_confianca, 0))"
_LANDING = ("has_customer_login", "has_contact_form", "coming_soon")


def _enriched_flag(name: str) -> str:
    landing = f"coalesce(g.{name}, false)"
    return f"{landing} AS {name}" if name in _LANDING else f"({landing} OR coalesce(r.{name}, false)) AS {name}"


STEPS["profiled_places"] = """
    SELECT p.* EXCLUDE (site_url, site_source), coalesce(nullif(b.website, ''), p.site_url) AS site_url,
      CASE WHEN nullif(b.website, '') IS NOT NULL THEN 'google_places' ELSE p.site_source END AS site_source,
      coalesce(b.google_place_match_score, 0) AS google_place_match_score,
      b.business_status AS google_business_status,
      CASE WHEN b.cnpj IS NULL THEN 'google_places_no_result' END AS retry_reason
    FROM profiled p LEFT JOIN place_best b ON b.cnpj = p.cnpj"""
STEPS["tried_all"] = tries("profiled_places")
STEPS["landed_all"] = (
    "SELECT t.*, k.page_id, k.url, k.status, k.content_type FROM tried_all t"
    " JOIN page_keys k ON k.url_key = t.url_key"
)
STEPS["owned_all"] = ownership("landed_all")
STEPS["attempted"] = """
    SELECT l.cnpj, l.attempt, l.page_id, l.status, l.candidate_url, l.candidate_source, o.fetch_error,
      o.retry_after_days, o.retry_after_hours, w.site_match_score, w.site_match_status,
      w.site_validation_reasons, w.site_match_score >= 70 AND w.site_match_status = 'validated' AS valid,
      l.status IS NOT NULL AND coalesce((w.site_match_score >= 70 AND w.site_match_status = 'validated')
        OR w.site_match_status = 'rejected_webmail' OR l.status IN (404, 410), false) AS stop
    FROM landed_all l JOIN outcomes o ON o.page_id = l.page_id
    LEFT JOIN owned_all w ON w.cnpj = l.cnpj AND w.attempt = l.attempt"""
STEPS["made"] = """
    SELECT a.* FROM attempted a JOIN (SELECT cnpj, coalesce(min(attempt) FILTER (stop), 9) AS stop_at
      FROM attempted GROUP BY 1) f ON f.cnpj = a.cnpj AND a.attempt <= f.stop_at"""
STEPS["picked"] = """
    SELECT cnpj, max(attempt) FILTER (status IS NOT NULL) AS site_at,
      max(attempt) FILTER (site_match_status IS NOT NULL) AS match_at,
      max(attempt) FILTER (fetch_error IS NOT NULL) AS error_at,
      coalesce(bool_or(contains(site_validation_reasons, 'cnpj_no_site')), false) AS cnpj_on_site
    FROM made GROUP BY 1"""
STEPS["read_visits"] = """
    SELECT s.* FROM signals s JOIN outcomes o ON o.page_id = s.page_id WHERE o.has_html"""
STEPS["read_rollup"] = merged("read_visits", "visit")
STEPS["sited"] = """
    SELECT p.*, s.page_id AS site_page, s.status AS site_status, s.candidate_url, s.candidate_source,
      coalesce(m.valid, false) AND coalesce(s.status NOT IN (404, 410), true) AS site_valid,
      coalesce(m.site_match_score, 0) AS site_match_score, m.site_match_status,
      m.site_validation_reasons, e.fetch_error, e.retry_after_days, e.retry_after_hours,
      coalesce(k.cnpj_on_site, false) AS cnpj_on_site
    FROM profiled_places p LEFT JOIN picked k ON k.cnpj = p.cnpj
    LEFT JOIN made s ON s.cnpj = k.cnpj AND s.attempt = k.site_at
    LEFT JOIN made m ON m.cnpj = k.cnpj AND m.attempt = k.match_at
    LEFT JOIN made e ON e.cnpj = k.cnpj AND e.attempt = k.error_at"""
STEPS["signalled"] = f"""
    SELECT p.* EXCLUDE (site_url, site_source), coalesce(o.reachable, false) AS site_reachable,
      coalesce({_READ}, false) AS page_read,
      CASE WHEN p.site_page IS NULL THEN p.site_url
        WHEN o.has_html OR p.site_status IN (401, 403) OR o.fetch_error = 'conteudo_nao_html' THEN k.url
        ELSE p.candidate_url END AS site_url,
      CASE WHEN p.site_page IS NULL THEN p.site_source ELSE p.candidate_source END AS site_source,
      {', '.join(_enriched_flag(f) for f in FLAGS)},
      (coalesce(g.chat_provider, '') <> '' OR coalesce(r.has_chat, false)) AS has_chat,
      CASE WHEN {_SURER} THEN r.plataforma ELSE g.plataforma END AS plataforma,
      CASE WHEN {_SURER} THEN r.plataforma_confianca ELSE coalesce(g.plataforma_confianca, 0) END AS plataforma_confianca,
      w.detected IS NOT NULL AS whatsapp_detected, w.normalized IS NOT NULL AS whatsapp_valid,
      w.normalized AS whatsapp_number_normalized, c.instagram AS instagram_url, c.linkedin AS linkedin_url,
      CASE WHEN w.normalized IS NULL THEN 'https://wa.me/' || {phone('p.telefone_1')} END AS telefone_candidato_whatsapp,
      p.domain_shared_count >= 3 AS domain_is_shared, coalesce(p.site_validation_reasons, '') AS reasons_text,
      NULL AS presence_maturity, NULL AS commerce_maturity, NULL AS confidence_score, NULL AS lead_score,
      NULL AS lead_classification, NULL AS digital_score, NULL AS digital_maturity, NULL AS score_version
    FROM sited p LEFT JOIN outcomes o ON o.page_id = p.site_page
    LEFT JOIN pg k ON k.page_id = p.site_page
    LEFT JOIN signals g ON g.page_id = p.site_page AND {_READ}
    LEFT JOIN read_rollup r ON p.site_valid AND r.host = g.host
    LEFT JOIN whatsapps w ON w.page_id = p.site_page AND {_READ}
    LEFT JOIN socials c ON c.page_id = p.site_page AND {_READ}"""
STEPS["enriched_rows"] = f"""
    SELECT *, CASE WHEN page_read AND site_valid AND {STRONG} THEN 'done' WHEN page_read THEN 'partial'
        WHEN coalesce(site_url, '') = '' THEN 'no_site' WHEN NOT site_reachable THEN 'failed'
        ELSE 'partial' END AS enrich_status
    FROM ({scored('signalled', _RETAIL_FIT)})"""
STEPS["enriched_channels"] = f"""
    SELECT *, {CHANNEL_COLUMNS} FROM (SELECT *, email AS email_original,
      'https://wa.me/' || whatsapp_number_normalized AS whatsapp_url FROM enriched_rows)"""

_STATEMENTS["enrich_candidates"] = f"""
    SELECT cnpj, email_tipo, domain_shared_count, enrich_status, site_valid, site_reachable,
      site_match_score, google_place_match_score, whatsapp_valid, plataforma_confianca, presence_score,
      commerce_score, fit_score, pain_score, confidence_score, lead_score, 1 AS enrich_attempts,
      {txt('decisor_nome', 'site_url', 'site_source', 'site_match_status', 'plataforma', 'instagram_url',
           'whatsapp_number_normalized', 'telefone_candidato_whatsapp', 'fetch_error', 'commerce_maturity',
           'lead_classification', 'site_validation_reasons')},
      {ts(f"""CASE WHEN retry_reason = 'google_places_no_result' THEN {NOW_TS} + to_days(90)
      WHEN retry_after_days IS NOT NULL THEN {NOW_TS} + to_days(retry_after_days)
      WHEN retry_after_hours IS NOT NULL THEN {NOW_TS} + to_hours(retry_after_hours)
      WHEN enrich_status = 'no_site' THEN {NOW_TS} + to_days(30)
      WHEN enrich_status = 'failed' THEN {NOW_TS} + to_hours(24) END""", 'next_retry_at', '')}
    FROM enriched_rows"""
_STATEMENTS["qualified_leads"] = f"""
    SELECT qualification_status, coalesce(contact_channel, '') AS contact_channel, count(*) AS total,
      CAST(sum(lead_score) AS BIGINT) AS soma_lead
    FROM ({qualified('enriched_channels', 60, 60)}) GROUP BY 1, 2"""

ORACLE: dict[str, str] = {name: statement(sql) for name, sql in _STATEMENTS.items()}

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import registry as R
from fichario.functions.text import clean_text, normalize_text, zero_pad
from fichario.operators import filters
from fichario.operators.clean import clean_rows
from fichario.schemas import DATASETS



def test_clean_text_strips_every_space(apply):
    assert apply(clean_text, ["  a b\t\x1c", "  ", "", None]) == ["a b", None, None, None]


def test_dates(apply):
    given = ["20260131", "", "00000000", "20260230", "2026131", " 20260131 ", "2026-01-31", None]
    day = date(2026, 1, 31)
    assert apply(R.parse_date, given) == [day, None, None, None, day, day, None, None]


def test_amounts(apply):
    given = ["1.234.567,89", "10,005", None, "abc", "0"]
    assert apply(R.parse_amount, given) == [
        Decimal("1234567.89"), Decimal("10.01"), Decimal("0.00"), None, Decimal("0.00"),
    ]


def test_branch_key_and_hash(spark):
    raw = spark.createDataFrame(
        [("12345678", "0001", "90") + ("",) * 27], DATASETS["Estabelecimentos"].raw_schema
    )
    row = clean_rows(raw, "Estabelecimentos", "2026-07").first()
    assert (row.cnpj, row.source_competence) == ("12345678000190", "2026-07")
    import hashlib

    partner = ("1", "2", " N ", "", "49", "20200102", "", "", "", "", "")
    frame = spark.createDataFrame([partner], DATASETS["Socios"].raw_schema)
    expected = hashlib.sha256("1|2|N||49|2020-01-02|||||".encode()).hexdigest()
    assert clean_rows(frame, "Socios", "2026-07").first().id == expected


def test_codes(apply):
    assert apply(R.normalize_cnae, ["111301", " 4781400", "abc", None]) == [
        "0111301", "4781400", "abc", "",
    ]
    assert apply(R.secondary_cnaes, ["1111111,4781400", "62,111301,111301", None]) == [
        ["1111111", "4781400"], ["0000062", "0111301"], [],
    ]
    assert apply(R.city_code, ["308", "12345", None]) == ["0308", "12345", "0000"]
    assert apply(R.state_code, ["sp"]) == ["SP"]
    assert apply(lambda x: zero_pad(x, 4), ["123456"]) == ["123456"]


def test_size_band(apply):
    rule = R.size_band(F.col("p"), F.col("m"), F.col("s"), F.col("c"))
    given = [
        ("01", "S", None, None), ("03", "N", None, "5"), (None, None, "S", None),
        (None, "N", "N", "10000000"), (None, None, None, "1000000"), (None, None, None, "x"),
    ]
    got = [r["faixa"] for r in apply(rule, given, "p string, m string, s string, c string")]
    assert got == [
        K.BAND_MEI, K.BAND_BY_PORTE["03"], K.BAND_SIMPLES, K.BAND_CAPITAL_HIGH,
        K.BAND_CAPITAL_MEDIUM, K.BAND_UNKNOWN,
    ]


def test_normalize_text(apply):
    given = ["Padaria São João LTDA", "Ação & Cia. S/A", "Loja™ ﬁna²", None, "me", "Ｌｏｊａ"]
    assert apply(normalize_text, given) == [
        "padaria sao joao", "acao cia", "lojatm fina2", "", "", "loja",
    ]


BRANCH = "situacao_cadastral string, uf string, municipio string, nome_fantasia string, " \
    "ddd1 string, telefone1 string, cnae_fiscal_principal string, cnaes_fiscais_secundarios string"


def branch(**given):
    row = {
        "situacao_cadastral": "02", "uf": "PR", "municipio": "0308", "nome_fantasia": "Loja",
        "ddd1": "41", "telefone1": "999887766", "cnae_fiscal_principal": "4751201",
        "cnaes_fiscais_secundarios": None,
    }
    return tuple({**row, **given}.values())


@pytest.mark.parametrize(
    "given, rules, kept",
    [
        ({}, {}, True),
        ({"situacao_cadastral": "08"}, {}, False),
        ({"uf": "SP"}, {"states": ("PR",)}, False),
        ({"uf": "pr"}, {"states": ("PR",)}, True),
        ({"nome_fantasia": " "}, {"require_trade_name": True}, False),
        ({"telefone1": ""}, {"require_phone": True}, False),
        ({"telefone1": "000000000"}, {"require_phone": True}, False),
        ({}, {"require_phone": True, "require_trade_name": True}, True),
        ({"cnae_fiscal_principal": "6201501", "cnaes_fiscais_secundarios": "1111111,4781400"}, {}, False),
        ({"cnae_fiscal_principal": "6201501", "cnaes_fiscais_secundarios": "1111111,4781400"},
         {"secondary_cnaes": True}, True),
        ({"cnae_fiscal_principal": "6201501"}, {"cnaes": ()}, True),
    ],
)
def test_branch_rules(spark, given, rules, kept):
    rows = spark.createDataFrame([branch(**given)], BRANCH)
    assert filters.filter_branches(rows, filters.BranchFilter(**rules)).count() == int(kept)


def test_city_floor(spark):
    rows = spark.createDataFrame([branch(uf="sp", municipio="308"), branch(uf="SP", municipio="9999")], BRANCH)
    cities = spark.createDataFrame([("SP", "0308", 200_000)], "uf string, codigo string, populacao int")
    rules = filters.BranchFilter(min_population=100_000)
    assert filters.filter_branches(rows, rules, cities).count() == 1
    with pytest.raises(ValueError):
        filters.filter_branches(rows, rules, cities.limit(0))


def test_retail_codes():
    assert len(set(K.RETAIL_CNAES)) == 18 and len(set(K.AREA_CODES)) == 67

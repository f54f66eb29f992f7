import pytest
from pyspark.sql import functions as F

from fichario.functions import contacts as C
from fichario.operators import contacts



def test_email_profile(apply):
    given = ["Contato@MinhaLoja.com.br", "loja@gmail.com", "nada", None, "a@b@uol.com.br"]
    assert apply(C.email_domain, given) == ["minhaloja.com.br", "gmail.com", None, None, "uol.com.br"]
    assert apply(C.email_kind, given) == [
        "corporativo", "gratuito", "invalido", "invalido", "gratuito",
    ]


def test_email_role(apply):
    given = ["fiscal@a.com", "rhumba@a.com", "vendas@a.com", "help@a.com", "ana.lima@a.com",
             "loja@a.com", "@a.com", None]
    assert apply(C.email_role, given) == [
        "accounting", "accounting", "sales", "support", "personal", "general", "unknown", "unknown",
    ]


@pytest.mark.parametrize(
    "raw, number",
    [
        ("11999998888", "5511999998888"), ("1234", None), ("0010119999888", None),
        ("5511999998888", "5511999998888"), ("(41) 3333-4444", "554133334444"),
        ("5533334444", None),  # area 55 without the country code reads as a country code
        ("11888888888", None), ("20999998888", None), (None, None), ("005511999998888", "5511999998888"),
    ],
)
def test_phone(apply, raw, number):
    assert apply(C.normalize_phone, [raw]) == [number]
    link = None if number is None else "https://wa.me/" + number
    assert apply(C.whatsapp_candidate, [raw]) == [link]


CHANNEL = "e string, t string, wv boolean, wn string, wu string, p string, pc string, i string"


def channel(apply, **given):
    row = dict(e=None, t=None, wv=False, wn=None, wu=None, p=None, pc=None, i=None)
    row.update(given)
    rule = C.contact_channel(*map(F.col, row))
    return tuple(apply(rule, [tuple(row.values())], CHANNEL)[0])


def test_contact_channel(apply):
    corporate = {"t": "corporativo"}
    assert channel(apply, e="fiscal@contador.com.br", p="1133334444", **corporate) == (
        "telefone_comercial", "1133334444", 60, "general")
    assert channel(apply, pc="https://wa.me/5511999998888")[:3] == (
        "whatsapp_candidato", "https://wa.me/5511999998888", 25)
    assert channel(apply, e=" vendas@a.com ", **corporate) == (
        "email_corporativo", "vendas@a.com", 85, "sales")
    assert channel(apply, e="loja@a.com", **corporate)[2:] == (75, "general")
    assert channel(apply, wv=True, wn="5511", p="1")[:3] == (
        "whatsapp_confirmado", "https://wa.me/5511", 90)
    assert channel(apply, e="nfe@a.com", **corporate)[:3] == ("email_corporativo", "nfe@a.com", 40)
    assert channel(apply, e="ana.lima@a.com", i="u", **corporate)[:3] == ("instagram", "u", 20)
    assert channel(apply) == (None, None, 0, "unknown")


def test_decision_maker(spark):
    rows = spark.createDataFrame(
        [
            ("1", "a", "Old", "22", "2001-01-01"), ("1", "b", "New admin", "49", None),
            ("1", "c", "First admin", "05", "2010-01-01"), ("1", "d", "Late admin", "16", "2015-01-01"),
            ("2", "f", "B", "22", None), ("2", "e", "A", "22", None),
        ],
        "cnpj_basico string, id string, nome_socio_razao_social string, qualificacao_socio string,"
        " data_entrada_sociedade string",
    ).withColumn("data_entrada_sociedade", F.col("data_entrada_sociedade").cast("date"))
    got = {r.cnpj_basico: r.decisor_nome for r in contacts.decision_makers(rows).collect()}
    assert got == {"1": "First admin", "2": "A"}


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_shared_domains(spark, hot_rows):
    rows = [(str(n), "gmail.com") for n in range(50)] + [("x", "a.com"), ("y", None), ("z", "")]
    frame = spark.createDataFrame(rows, "cnpj string, email_dominio string")
    got = {r.cnpj: r.domain_shared_count for r in contacts.shared_domain_counts(frame, hot_rows).collect()}
    assert len(got) == 53
    assert {got[str(n)] for n in range(50)} == {49}
    assert (got["x"], got["y"], got["z"]) == (0, 0, 0)


def test_a_batch_sees_the_domains_of_the_stored_companies(spark):
    batch = spark.createDataFrame([("1", "a.com"), ("2", "b.com"), ("3", None)], "cnpj string, email_dominio string")
    stored = spark.createDataFrame(
        [("1", "b.com"), ("4", "a.com"), ("5", "a.com"), ("5", "a.com"), ("6", "")], "cnpj string, email_dominio string")
    got = {r.cnpj: r.domain_shared_count for r in contacts.shared_domain_counts(batch, stored=stored).collect()}
    assert got == {"1": 2, "2": 0, "3": 0}

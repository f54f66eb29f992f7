"""The population load: fresh tables stay, unknown values leave the stored row, repeats count once."""

import json

import pytest
from pyspark.sql import functions as F

from fichario.plans.population import load_population

SCHEMA = "codigo_ibge string, uf string, codigo string, nome string, populacao int, ano_referencia int, updated_at timestamp"


def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")


@pytest.fixture
def files(tmp_path):
    cities = [("3550308", "SP", "São Paulo"), ("4106902", "PR", "Curitiba"), ("1100015", "RO", "Alta Floresta")]
    state = lambda uf: {"regiao-intermediaria": {"UF": {"sigla": uf}}}
    (tmp_path / "cities.json").write_text(
        json.dumps([{"id": i, "nome": n, "regiao-imediata": state(uf)} for i, uf, n in cities]))
    values = {"3550308": "11.451.999", "4106902": "1773718", "1100015": "..."}
    series = [{"localidade": {"id": i}, "serie": {"2024": v, "2010": "1"}} for i, v in values.items()]
    series.append({"localidade": {"id": "4106902"}, "serie": {"2024": "5"}})
    (tmp_path / "series.json").write_text(json.dumps([{"resultados": [{"series": series}]}]))
    return str(tmp_path / "cities.json"), str(tmp_path / "series.json")


def rows(frame):
    return sorted((r.codigo_ibge, r.uf, r.codigo, r.populacao, r.ano_referencia) for r in frame.collect())


def test_first_load_and_merge(spark, files):
    new = [("3550308", "SP", "0308", 11451999, 2024), ("4106902", "PR", "6902", 1773718, 2024)]
    first = load_population(spark, None, *files, 2024, now())
    assert first.loaded and rows(first.table) == new
    assert first.report.first().asDict() == {"cidades": 2, "merged": 2, "left_out": 1}
    old = spark.createDataFrame(
        [("1100015", "RO", "0015", "Alta", 9, 2023, None), ("3550308", "SP", "0308", "SP", 7, 2023, None)], SCHEMA)
    merged = load_population(spark, old, *files, 2024, now())
    assert rows(merged.table) == [("1100015", "RO", "0015", 9, 2023), *new]
    # a later year that the files do not have changes nothing
    assert rows(load_population(spark, old, *files, 2025, now()).table) == rows(old)


def test_complete_year_reads_no_file(spark):
    held = spark.createDataFrame([("1100015", "RO", "0015", "Alta", 9, 2024, None)], SCHEMA)
    again = load_population(spark, held, "none", "none", 2024, now(), complete=1)
    assert not again.loaded and rows(again.table) == rows(held)
    assert again.report.first().asDict() == {"cidades": 0, "merged": 0, "left_out": 0}

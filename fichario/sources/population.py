"""City population files: series (S6), city catalogue (S7) and the population table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario.functions.text import digits, zero_pad

SERIES_SCHEMA = (
    "resultados array<struct<series: array<struct<localidade: struct<id: string>, "
    "serie: map<string, string>>>>>"
)
CATALOGUE_SCHEMA = (
    "id string, nome string, "
    "`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>, "
    "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>"
)


def city_code_of(ibge_id: Column) -> Column:
    """Registry city code: the last four digits of the statistical code."""
    return zero_pad(F.right(ibge_id, F.lit(4)), 4)


def read_series(
    spark: SparkSession, path: str, year: int, multi_line: bool = True
) -> DataFrame:
    """(codigo_ibge, populacao) of one year; values without digits are left out.

    One JSON document per file; ``multi_line=False`` reads one document per line instead.
    """
    raw = spark.read.schema(SERIES_SCHEMA).option("multiLine", multi_line).json(path)
    results = raw.select(F.explode("resultados").alias("r"))
    series = results.select(F.explode("r.series").alias("s"))
    value = F.nullif(digits(F.try_element_at("s.serie", F.lit(str(year)))), F.lit(""))
    return series.select(
        F.col("s.localidade.id").alias("codigo_ibge"), value.try_cast("int").alias("populacao")
    ).filter(F.col("populacao").isNotNull())


def read_catalogue(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(codigo_ibge, uf, codigo, nome); the state comes from either region path."""
    raw = spark.read.schema(CATALOGUE_SCHEMA).option("multiLine", multi_line).json(path)
    state = F.coalesce(
        F.col("`regiao-imediata`.`regiao-intermediaria`.UF.sigla"),
        F.col("microrregiao.mesorregiao.UF.sigla"),
    )
    return raw.select(
        F.col("id").alias("codigo_ibge"),
        state.alias("uf"),
        city_code_of(F.col("id")).alias("codigo"),
        "nome",
    )


def population_table(catalogue: DataFrame, series: DataFrame, year: int) -> DataFrame:
    """Cities with a known population."""
    return catalogue.join(series, "codigo_ibge").withColumn("ano_referencia", F.lit(year))


def cities_without_population(catalogue: DataFrame, series: DataFrame) -> DataFrame:
    """The cities left out, for the load report."""
    return catalogue.join(series.select("codigo_ibge"), "codigo_ibge", "left_anti")

"""Population load: check what is stored -> read both files -> join -> merge -> report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.operators import reports, upsert
from fichario.sources import population as sources


@dataclass
class PopulationLoad:
    table: DataFrame
    report: DataFrame
    loaded: bool


def load_population(
    spark: SparkSession,
    stored: DataFrame | None,
    catalogue_path: str,
    series_path: str,
    year: int,
    now: Column,
    *,
    complete: int = K.COMPLETE_POPULATION_ROWS,
    multi_line: bool = True,
) -> PopulationLoad:
    """Bring the population table to a year.

    A table that holds ``complete`` cities of the year is returned as it is and no file is read.
    Otherwise cities with a known population are merged by statistical code (of repeated ones the
    largest value); cities without one keep their stored row. The report has the rows merged, the
    cities left out and the large cities of the resulting table. Nothing is written here.
    """
    if stored is not None:
        known = reports.year_count(stored, year).first()["linhas"]
        if known >= complete:
            return PopulationLoad(stored, _report(F.lit(0), F.lit(0), stored), False)
    catalogue = sources.read_catalogue(spark, catalogue_path, multi_line)
    series = sources.read_series(spark, series_path, year, multi_line)
    cities = upsert.latest_per_key(
        sources.population_table(catalogue, series, year), "codigo_ibge", ["populacao"]
    )
    if stored is None:
        table = cities.withColumn("updated_at", now)
    else:
        table = upsert.merge_latest(stored, cities, "codigo_ibge", now=now)
    merged = cities.agg(F.count("*").alias("merged"))
    left_out = sources.cities_without_population(catalogue, series).agg(F.count("*").alias("left_out"))
    report = _report(merged.scalar(), left_out.scalar(), table)
    return PopulationLoad(table, report, True)


def _report(merged: Column, left_out: Column, table: DataFrame) -> DataFrame:
    return reports.large_city_count(table).withColumns(
        {"merged": merged.cast("long"), "left_out": left_out.cast("long")}
    )

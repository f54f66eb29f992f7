"""Report jobs A1-A5, A8-A10, L5 and the load audit S17. All are hash aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K


def counts_by(rows: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """A1, A3, A5: rows per value; NULL values left out unless asked for."""
    kept = rows if keep_null else rows.filter(F.col(column).isNotNull())
    return kept.groupBy(column).agg(F.count(F.lit(1)).alias("total"))


def section_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """A3: rows per value of several columns, a section (secao, valor, total) each; one scan."""
    pairs = [F.struct(F.lit(c).alias("secao"), F.col(c).cast("string").alias("valor")) for c in columns]
    return (
        rows.select(F.explode(F.array(*pairs)).alias("x")).select("x.secao", "x.valor")
        .filter(F.col("valor").isNotNull()).groupBy("secao", "valor").agg(F.count(F.lit(1)).alias("total"))
    )


def valid_contact_counts(state: DataFrame) -> DataFrame:
    """A2."""
    return state.agg(
        F.count_if(F.col("site_valid")).alias("sites_valid"),
        F.count_if(F.col("whatsapp_valid")).alias("whatsapps_valid"),
    )


def top_platforms(state: DataFrame, limit: int = 20) -> DataFrame:
    """A4: most frequent platforms, name order on ties."""
    return counts_by(state, "plataforma").orderBy(F.desc("total"), "plataforma").limit(limit)


def run_stats(attempts: DataFrame, run: str = "run_id", status: str = "enrich_status") -> DataFrame:
    """Processed rows and outcomes per enrichment run."""
    outcomes = ("done", "partial", "no_site", "failed")
    return attempts.groupBy(run).agg(
        F.count(F.lit(1)).alias("processed"),
        *[F.count_if(F.col(status) == s).alias(s) for s in outcomes],
    )


def large_city_count(population: DataFrame, floor: int = K.LARGE_CITY) -> DataFrame:
    """A9."""
    return population.filter(F.col("populacao") >= floor).agg(F.count(F.lit(1)).alias("cidades"))


def year_count(population: DataFrame, year: int) -> DataFrame:
    """A10 + S9: rows of one year, whether any exist and whether the load is complete."""
    return population.filter(F.col("ano_referencia") == year).agg(
        F.count(F.lit(1)).alias("linhas")
    ).select(
        "linhas",
        (F.col("linhas") > 0).alias("existe"),
        (F.col("linhas") >= K.COMPLETE_POPULATION_ROWS).alias("completa"),
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Latest load runs, newest id first, 1 to 100 of them."""
    return runs.orderBy(F.col("id").desc()).limit(max(1, min(100, limit))).select(
        "id", "competence", "status", "started_at", "finished_at", "files_processed",
        "rows_processed",
    )


def file_audit(plan: DataFrame, loaded: DataFrame, now: Column) -> DataFrame:
    """Audit row per planned file.

    ``loaded``: file_name, rows_processed, sha256, error_message of the files read. A planned file
    that was not read, or that has an error, is ``failed``; messages are kept whole. Their size does not
    show in the size of the files they come from, so the join is never a broadcast, which would put
    all messages into the memory of each task: each task sorts its share.
    """
    joined = plan.join(loaded.hint("merge"), "file_name", "left")
    failed = F.col("rows_processed").isNull() | F.col("error_message").isNotNull()
    return joined.select(
        "competence", "file_name", "file_type", "source_size", "source_last_modified", "sha256",
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.coalesce(F.col("rows_processed"), F.lit(0)).alias("rows_processed"),
        now.alias("processed_at"),
        F.col("error_message"),
    )


def run_audit(files: DataFrame, competence: str) -> DataFrame:
    """One row for the whole run; ``skipped`` when nothing had to be read."""
    totals = files.agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(F.col("status") == "success").alias("files_processed"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("rows_processed"),
        F.count_if(F.col("status") == "failed").alias("_failed"),
    )
    status = (
        F.when(F.col("files_total") == 0, "skipped")
        .when(F.col("_failed") > 0, "failed")
        .otherwise("success")
    )
    return totals.select(
        F.lit(competence).alias("competence"), status.alias("status"),
        "files_total", "files_processed", "rows_processed",
    )

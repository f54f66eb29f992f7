"""Registry views J1-J4, J6, J7 and the sample report L3.

No join carries a broadcast hint: Spark broadcasts the lookups by their measured size and uses a
shuffled join, with skew splitting, for anything larger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions.registry import phone_text
from fichario.operators import by_root, skew
from fichario.operators.by_root import ByRoot
from fichario.operators.filters import is_active, is_retail

Tables = Mapping[str, DataFrame]


def complete_companies(t: Tables, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """One row per branch with company, lookup descriptions and tax-regime options.

    Company and tax regime are joined on the same (root, salt) partitioning, so the branches
    shuffle once, and a root that owns a large share of all branches is spread over many tasks.
    """
    branches = t["estabelecimentos"]
    hot = skew.hot_keys(skew.key_counts(branches, "cnpj_basico"), "cnpj_basico", hot_rows)
    companies = t["empresas"].select(
        "cnpj_basico", "razao_social", "natureza_juridica", "capital_social", "porte"
    )
    simples = t["simples"].select("cnpj_basico", "opcao_simples", "opcao_mei")
    root = ["cnpj_basico", "_salt"]
    joined = (
        skew.add_salt(branches, "cnpj_basico", hot, ["cnpj"])
        .join(skew.copy_per_salt(companies, "cnpj_basico", hot), root)
        .join(skew.copy_per_salt(simples, "cnpj_basico", hot), root, "left")
    )
    return _described(joined, t)


def stored_companies(roots: Mapping[str, ByRoot], t: Tables) -> DataFrame:
    """J1 over tables stored by root: branches, companies and tax regimes meet where they lie, and
    nothing is counted; lookups come from ``t``."""
    companies = roots["empresas"].map(lambda rows: rows.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "capital_social", "porte"))
    simples = roots["simples"].map(lambda rows: rows.select("cnpj_basico", "opcao_simples", "opcao_mei"))
    joined = by_root.join(by_root.join(roots["estabelecimentos"], companies), simples, "left")
    return _described(joined.all(), t)


def _described(joined: DataFrame, t: Tables) -> DataFrame:
    """Lookup descriptions, and the columns of the view."""
    for table, code, description in (
        ("cnaes", "cnae_fiscal_principal", "cnae_principal_descricao"),
        ("municipios", "municipio", "municipio_descricao"),
        ("naturezas_juridicas", "natureza_juridica", "natureza_juridica_descricao"),
    ):
        lookup = t[table].select(
            F.col("codigo").alias(code), F.col("descricao").alias(description)
        )
        joined = joined.join(lookup, code, "left")
    return joined.select(
        "cnpj", "cnpj_basico", "razao_social", "nome_fantasia", "natureza_juridica",
        "natureza_juridica_descricao", "capital_social", "porte", "identificador_matriz_filial",
        "situacao_cadastral", "data_inicio_atividade", "cnae_fiscal_principal",
        "cnae_principal_descricao", "cnaes_fiscais_secundarios", "tipo_logradouro", "logradouro",
        "numero", "complemento", "bairro", "cep", "uf", "municipio", "municipio_descricao",
        phone_text(F.col("ddd1"), F.col("telefone1")).alias("telefone_1"),
        phone_text(F.col("ddd2"), F.col("telefone2")).alias("telefone_2"),
        F.lower("correio_eletronico").alias("email"),
        "opcao_simples", "opcao_mei", "source_competence", "updated_at",
    )


def retail_branches(complete: DataFrame, population: DataFrame) -> DataFrame:
    """Active retail branches with name and phone in cities of 100,000 people or more."""
    cities = population.filter(F.col("populacao") >= K.LARGE_CITY).select(
        F.col("uf").alias("_uf"), F.col("codigo").alias("_codigo"),
        F.col("populacao").alias("municipio_populacao"),
        F.col("ano_referencia").alias("municipio_pop_ano"),
    )
    # The stored columns are compared here, so blank means ASCII spaces as in SQL's btrim.
    named = F.coalesce(F.trim("nome_fantasia"), F.lit("")) != ""
    kept = complete.filter(is_active() & is_retail() & named & (F.trim("telefone_1") != ""))
    joined = kept.join(
        cities, (F.col("uf") == F.col("_uf")) & (F.col("municipio") == F.col("_codigo"))
    )
    return joined.drop(
        "_uf", "_codigo", "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep"
    )


def prospect_candidates(complete: DataFrame) -> DataFrame:
    """Active retail branches, no other condition."""
    return complete.filter(is_active() & is_retail())


_DIGITAL_COLUMNS = (
    "email_dominio", "email_tipo", "site_url", "site_ativo", "site_http_status", "plataforma",
    "plataformas_detectadas", "instagram_url", "whatsapp_url", "linkedin_url", "decisor_nome",
    "decisor_qualificacao", "faixa_faturamento_estimada", "faturamento_fonte", "digital_score",
    "digital_maturity", "sinais", "enrich_status",
)


def prospect_digital(retail: DataFrame, state: DataFrame) -> DataFrame:
    """Retail view with the stored enrichment state, if any."""
    columns = [c for c in _DIGITAL_COLUMNS if c in state.columns]
    digital = state.select("cnpj", *columns, F.col("enriched_at").alias("digital_enriched_at"))
    return retail.join(digital, "cnpj", "left")


def rescore_input(state: DataFrame, candidates: DataFrame, version: str) -> DataFrame:
    """Stored rows scored under another version, with the candidate's activity code."""
    stale = state.filter(~F.col("score_version").eqNullSafe(F.lit(version)))
    return stale.drop("cnae_fiscal_principal").join(
        candidates.select("cnpj", "cnae_fiscal_principal"), "cnpj", "left"
    )


def queue_input(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Candidates with what is stored about their last attempt."""
    stored = state.select(
        "cnpj", F.lit(True).alias("has_state"), "enrich_status", "enrichment_version",
        "next_retry_at", "enrich_attempts", "google_place_id", "google_places_checked_at",
        "processing_run_id", "processing_started_at",
    )
    return candidates.join(stored, "cnpj", "left")


def newest_active(complete: DataFrame, state: str, cnae: str, limit: int = 100) -> DataFrame:
    """L3: newest active branches of one state and activity; ties by key.

    A sort with a limit keeps only ``limit`` rows per task, so there is no global sort.
    """
    return (
        complete.filter(
            is_active() & (F.col("uf") == state) & (F.col("cnae_fiscal_principal") == cnae)
        )
        .orderBy(F.col("data_inicio_atividade").desc_nulls_first(), "cnpj")
        .limit(limit)
        .select("cnpj", "razao_social", "nome_fantasia", "telefone_1", "email", "uf",
                "data_inicio_atividade")
    )

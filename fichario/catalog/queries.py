"""The registered queries, one per operator, named after its id in the survey.

Each query takes the inputs of one folder and returns plain columns (texts, numbers, flags), so
the result compares with the SQL of the same name in ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.catalog.inputs import COMPETENCE, YEAR, Inputs
from fichario.functions import contacts as C
from fichario.functions import pages as P
from fichario.functions import registry as R
from fichario.functions import urls
from fichario.functions.text import clean_text, normalize_text
from fichario.operators import (
    changes, contacts, filters, leads, pages, queue, reports, sites, upsert, views)
from fichario.operators.clean import clean_rows
from fichario.plans import enrich, ingest, population
from fichario.schemas import DATASETS
from fichario.session import new_folder
from fichario.sources import population as pop
from fichario.sources import ranges, registry_files, releases
from fichario.streaming import releases as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[Inputs], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Inputs(spark, folder))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def moment(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def listed(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def filled(*names: str) -> list[Column]:
    """Text columns with NULL shown as empty text."""
    return [F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names]


# --- Sources and sinks -----------------------------------------------------------------------


@query
def s1_registry_scan(i: Inputs) -> DataFrame:
    """Company rows written in the release format and read back."""
    path = new_folder(i.spark, "release")
    registry_files.write_delimited(i.raw("raw_empresas"), "Empresas", path)
    rows = ranges.read_ranges(i.spark, path, "Empresas", range_bytes=1 << 20)
    return rows.select(*filled(*DATASETS["Empresas"].columns))


@query
def s2_zipped_scan(i: Inputs) -> DataFrame:
    """Partner rows written as ZIP snapshots and read back."""
    folder = new_folder(i.spark, "zips")
    raw = i.raw("raw_socios", spread=True)
    paths = registry_files.write_zipped(raw, "Socios", folder, "Socios")
    written = [row.source_path for row in paths.collect()]  # one row per file
    return registry_files.read_zipped(i.spark, written, "Socios").select(
        *filled(*DATASETS["Socios"].columns)
    )


@query
def s3_dataset_catalog(i: Inputs) -> DataFrame:
    """Rows and distinct keys of every loaded dataset, by the catalogue's key."""
    counted = None
    for name, table in i.registry.items():
        dataset = next(d for d in DATASETS.values() if d.table == name)
        row = table.agg(
            F.count(F.lit(1)).alias("linhas"), F.count_distinct(dataset.key).alias("chaves")
        ).select(
            F.lit(dataset.kind).alias("tipo"), F.lit(name).alias("tabela"),
            F.lit(dataset.key).alias("chave"), "linhas", "chaves",
        )
        counted = row if counted is None else counted.unionByName(row)
    return counted


@query
def s4_file_kinds(i: Inputs) -> DataFrame:
    return releases.known_files(i.raw("listing")).select("competence", "name", "file_type")


@query
def s5_latest_release(i: Inputs) -> DataFrame:
    return releases.latest_release(i.raw("listing"))


def _series_files(i: Inputs) -> str:
    """The city series written as JSON documents, with separators and unknown values."""
    cities = i.population
    shown = F.concat((F.col("populacao") / 1000).cast("int").cast("string"), F.lit("."),
                     F.lpad((F.col("populacao") % 1000).cast("string"), 3, "0"))
    value = F.when(F.col("codigo") == "0007", "...").otherwise(shown)
    series = F.struct(
        F.struct(F.col("codigo_ibge").alias("id")).alias("localidade"),
        F.create_map(F.lit(str(YEAR)), value, F.lit("2010"), F.lit("1")).alias("serie"),
    )
    documents = cities.select(F.array(F.struct(F.array(series).alias("series"))).alias("resultados"))
    path = new_folder(i.spark, "series")
    documents.write.json(path)
    return path


def _series(i: Inputs) -> DataFrame:
    return pop.read_series(i.spark, _series_files(i), YEAR, multi_line=False)


def _catalogue_files(i: Inputs) -> str:
    """The city catalogue written as JSON documents, half per region path."""
    state = F.struct(F.struct(F.col("uf").alias("sigla")).alias("UF"))
    old = F.col("populacao") % 2 == 0
    path = new_folder(i.spark, "catalogue")
    i.population.select(
        F.col("codigo_ibge").alias("id"),
        "nome",
        F.when(~old, F.struct(state.alias("regiao-intermediaria"))).alias("regiao-imediata"),
        F.when(old, F.struct(state.alias("mesorregiao"))).alias("microrregiao"),
    ).write.json(path)
    return path


def _catalogue(i: Inputs) -> DataFrame:
    return pop.read_catalogue(i.spark, _catalogue_files(i), multi_line=False)


@query
def s6_population_series(i: Inputs) -> DataFrame:
    return _series(i)


@query
def s7_city_catalogue(i: Inputs) -> DataFrame:
    return _catalogue(i)


@query
def s8_population_table(i: Inputs) -> DataFrame:
    return pop.population_table(_catalogue(i), _series(i), YEAR)


@query
def load_population(i: Inputs) -> DataFrame:
    """The population load over an older table that lacks some cities and has others, then again: the second run finds
    the year complete and reads nothing (its paths do not exist)."""
    later = F.lit("2025-01-01 00:00:00").cast("timestamp")
    other = F.when(F.col("codigo_ibge") % 4 == 0, "9").otherwise("")
    stored = i.population.withColumns({
        "codigo_ibge": F.concat(other, "codigo_ibge"), "populacao": F.col("populacao") + 1,
        "ano_referencia": F.lit(YEAR - 1), "updated_at": i.now,
    })
    first = population.load_population(
        i.spark, stored, _catalogue_files(i), _series_files(i), YEAR, later, multi_line=False
    )
    table = i.saved("population_loaded", lambda: first.table)
    again = population.load_population(i.spark, table, "none", "none", YEAR, later, complete=1)
    done = again.table.withColumn("updated_at", moment("updated_at"))
    return done.withColumns({c: first.report.select(c).scalar() for c in first.report.columns})


@query
def s9_population_check(i: Inputs) -> DataFrame:
    return reports.year_count(i.population, YEAR)


def _company_updates(i: Inputs) -> DataFrame:
    """Changed companies: two files of one release, some roots in both, some roots new."""
    rows = i.registry["empresas"].withColumns(
        {"competence": F.lit("2026-08"), "row_id": F.lit(1), "source_competence": F.lit("2026-08")}
    )
    amount = F.coalesce(F.col("capital_social"), F.lit(0))
    first = rows.filter(amount > 1_000_000).withColumns(
        {"file_name": F.lit("a"), "razao_social": F.concat(F.lit("A "), "razao_social")}
    )
    second = rows.filter(F.col("porte") == "03").withColumns(
        {"file_name": F.lit("b"), "razao_social": F.concat(F.lit("B "), "razao_social")}
    )
    new = rows.filter(F.col("porte") == "05").withColumns(
        {"file_name": F.lit("c"), "cnpj_basico": F.concat(F.lit("N"), "cnpj_basico")}
    )
    return first.unionByName(second).unionByName(new)


@query
def s10_fact_upsert(i: Inputs) -> DataFrame:
    merged = upsert.merge_latest(
        i.registry["empresas"], _company_updates(i), "cnpj_basico",
        now=F.lit("2026-08-02 00:00:00").cast("timestamp"),
        order=["competence", "file_name", "row_id"],
    )
    return merged.select(
        "cnpj_basico", "razao_social", "source_competence", moment("updated_at"),
        F.coalesce(money("capital_social"), F.lit(-1.0)).alias("capital_social"),
    )


@query
def s10_change_rows(i: Inputs) -> DataFrame:
    """What a merge of changed companies does to each, and what the same merge does once more."""
    now, order = F.lit("2026-08-02 00:00:00").cast("timestamp"), ["competence", "file_name", "row_id"]
    base = changes.hashed(i.registry["empresas"], "cnpj_basico")
    updates = _company_updates(i)
    first = changes.merge_changes(base, updates, "cnpj_basico", now, order)
    table = changes.apply_changes(base, first, "cnpj_basico")
    again = changes.merge_changes(table, updates, "cnpj_basico", now, order)
    return first.select("cnpj_basico", F.col("change").alias("first_change"), "after.razao_social").join(
        again.select("cnpj_basico", F.col("change").alias("second_change")), "cnpj_basico")


@query
def s11_lookup_upsert(i: Inputs) -> DataFrame:
    nations = i.table("nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("codigo"),
        F.concat(F.lit("Nova "), "n_name").alias("descricao"), "n_regionkey",
    )
    changed = nations.filter("n_regionkey = 1").drop("n_regionkey")
    added = nations.filter("n_regionkey = 2").select(
        F.concat(F.lit("9"), F.right("codigo", F.lit(3))).alias("codigo"), "descricao"
    )
    return upsert.merge_lookup(i.registry["municipios"], changed.unionByName(added))


@query
def s12_population_upsert(i: Inputs) -> DataFrame:
    updates = i.population.filter("populacao % 2 = 0").withColumns(
        {"populacao": F.col("populacao") + 5, "ano_referencia": F.lit(2025)}
    )
    stored = i.population.withColumn("updated_at", i.now)
    later = F.lit("2025-01-01 00:00:00").cast("timestamp")
    merged = upsert.merge_latest(stored, updates, "codigo_ibge", now=later)
    return merged.withColumn("updated_at", moment("updated_at"))


@query
def s13_enrichment_upsert(i: Inputs) -> DataFrame:
    """New results for the closed branches, known or not, merged into the stored state."""
    columns = ["cnpj", "cnpj_basico", "enrich_status", "lead_score", "plataforma", "enriched_at",
               "processing_run_id", "processing_started_at"]
    results = i.registry["estabelecimentos"].filter("situacao_cadastral = '08'").select(
        "cnpj", "cnpj_basico", F.lit("done").alias("enrich_status"), F.lit(77).alias("lead_score"),
        F.lit("vtex").alias("plataforma"),
    )
    merged = upsert.merge_enrichment(
        i.state.select(*columns, "site_match_status", "digital_score"), results, i.now
    )
    return merged.select(
        "cnpj", "enrich_status", *filled("lead_score", "plataforma", "processing_run_id",
                                         "site_match_status", "digital_score"),
        moment("enriched_at"),
    )


def _history(i: Inputs) -> DataFrame:
    """Qualification rows stored earlier, for the branches without a rejected site."""
    rows = i.state.filter(F.col("site_match_status") != "rejected_webmail")
    return rows.select(
        "cnpj", F.concat(F.lit("old"), "cnpj_basico").alias("cnpj_basico"),
        F.lit("review_required").alias("qualification_status"),
        "lead_score", F.col("enriched_at").alias("qualified_at"),
        F.col("enriched_at").alias("last_qualified_at"), F.col("enriched_at").alias("updated_at"),
        F.concat(F.lit("nota "), "cnpj").alias("history_note"),
    )


@query
def s14_qualification_upsert(i: Inputs) -> DataFrame:
    """Qualifications of the finished candidates merged into the history."""
    evaluated = leads.qualify(i.candidates, i.state)
    merged = upsert.merge_qualification(_history(i), evaluated, i.now)
    return merged.select(
        "cnpj", "cnpj_basico", "qualification_status",
        *filled("lead_score", "contact_channel", "history_note"),
        moment("qualified_at"), moment("last_qualified_at"),
    )


def _audit(i: Inputs) -> DataFrame:
    """Audit of earlier loads: some sizes and dates changed since, some loads failed."""
    return i.raw("listing").select(
        "competence", F.col("name").alias("file_name"),
        F.when(F.length("name") % 4 == 0, "failed").otherwise("success").alias("status"),
        F.when(F.col("size") % 3000 == 0, F.col("size") + 1).otherwise(F.col("size")).alias(
            "source_size"
        ),
        F.when(F.col("last_modified") == "ECONOMY", "then").otherwise(
            F.col("last_modified")
        ).alias("source_last_modified"),
    )


@query
def s15_files_to_load(i: Inputs) -> DataFrame:
    due = releases.files_to_load(i.raw("listing"), _audit(i))
    return due.select("competence", "name", "file_type")


@query
def s17_load_audit(i: Inputs) -> DataFrame:
    """File audit of a load in which some files were read, some failed and some never came."""
    plan = releases.known_files(i.raw("listing")).select(
        "competence", F.col("name").alias("file_name"), "file_type",
        F.col("size").alias("source_size"), F.col("last_modified").alias("source_last_modified"),
    )
    loaded = plan.filter(F.col("source_size").isNotNull()).select(
        "file_name", F.col("source_size").alias("rows_processed"), F.lit(None).cast("string").alias(
            "sha256"
        ),
        F.when(F.col("source_size") % 7000 == 0, F.repeat(F.lit("erro "), 1000)).alias(
            "error_message"
        ),
    )
    audit = reports.file_audit(plan, loaded, i.now)
    return audit.select(
        "competence", "file_name", "file_type", "status", "rows_processed",
        F.coalesce(F.length("error_message"), F.lit(0)).alias("error_length"),
    )


@query
def s17_run_audit(i: Inputs) -> DataFrame:
    """Run audit: the totals of a file audit."""
    files = i.raw("listing").select(
        "competence", F.col("size").alias("rows_processed"),
        F.when(F.col("size").isNull(), "failed").otherwise("success").alias("status"),
    )
    return reports.run_audit(files, COMPETENCE)


# --- Cleaning ---------------------------------------------------------------------------------


@query
def p1_clean_text(i: Inputs) -> DataFrame:
    raw = i.raw("raw_empresas")
    return raw.select("cnpj_basico", clean_text(F.col("razao_social")).alias("razao_social"),
                      F.coalesce(clean_text(F.col("porte")), F.lit("-")).alias("porte"))


@query
def p2_dates(i: Inputs) -> DataFrame:
    rows = clean_rows(i.raw("raw_estabelecimentos", spread=True), "Estabelecimentos", COMPETENCE)
    return rows.select("cnpj", day("data_situacao_cadastral"), day("data_inicio_atividade"))


@query
def p3_amounts(i: Inputs) -> DataFrame:
    rows = clean_rows(i.raw("raw_empresas"), "Empresas", COMPETENCE)
    return rows.select(
        "cnpj_basico", F.coalesce(money("capital_social"), F.lit(-1.0)).alias("capital_social")
    )


@query
def p4_branch_key(i: Inputs) -> DataFrame:
    raw = i.raw("raw_estabelecimentos")
    key = R.branch_key(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv"))
    return raw.select("cnpj_basico", key.alias("cnpj"))


@query
def p5_content_hash(i: Inputs) -> DataFrame:
    rows = clean_rows(i.raw("raw_socios", spread=True), "Socios", COMPETENCE)
    return rows.select("cnpj_basico", "nome_socio_razao_social", "id")


@query
def p6_release_stamp(i: Inputs) -> DataFrame:
    rows = clean_rows(i.raw("raw_simples"), "Simples", "2026-07")
    return rows.select("cnpj_basico", "opcao_mei", "source_competence")


@query
def p7_cnae(i: Inputs) -> DataFrame:
    raw = i.raw("raw_estabelecimentos")
    code = R.normalize_cnae(F.col("cnae_fiscal_principal"))
    key = R.branch_key(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv"))
    return raw.select(key.alias("cnpj"), code.alias("cnae"))


@query
def p8_secondary_cnaes(i: Inputs) -> DataFrame:
    codes = R.secondary_cnaes(F.col("cnaes_fiscais_secundarios"))
    return i.registry["estabelecimentos"].select("cnpj", F.array_join(codes, "|").alias("cnaes"))


@query
def p9_city_key(i: Inputs) -> DataFrame:
    return i.registry["estabelecimentos"].select(
        "cnpj", R.state_code(F.col("uf")).alias("uf"), R.city_code(F.col("municipio")).alias("codigo")
    )


@query
def p10_phones(i: Inputs) -> DataFrame:
    return i.registry["estabelecimentos"].select(
        "cnpj", R.phone_text(F.col("ddd1"), F.col("telefone1")).alias("telefone_1"),
        R.phone_text(F.col("ddd2"), F.col("telefone2")).alias("telefone_2"),
    )


@query
def p11_size_band(i: Inputs) -> DataFrame:
    rows = i.registry["empresas"].join(
        i.registry["simples"].select("cnpj_basico", "opcao_mei", "opcao_simples"),
        "cnpj_basico", "left",
    )
    return contacts.size_bands(rows).select(
        "cnpj_basico", "faixa_porte_receita", "porte_receita_fonte"
    )


@query
def p12_normalize_names(i: Inputs) -> DataFrame:
    return i.registry["empresas"].select(
        "cnpj_basico", normalize_text(F.col("razao_social")).alias("nome")
    )


@query
def p12_normalize_documents(i: Inputs) -> DataFrame:
    """Whole document texts in four languages."""
    text = normalize_text(F.col("text"))
    return i.spread_table("documents").select("doc_id", F.md5(text).alias("hash"))


# --- Filters ----------------------------------------------------------------------------------


def _branches(i: Inputs) -> DataFrame:
    return i.registry["estabelecimentos"]


@query
def f1_active(i: Inputs) -> DataFrame:
    return _branches(i).filter(filters.is_active()).select("cnpj")


@query
def f2_states(i: Inputs) -> DataFrame:
    return _branches(i).filter(filters.in_states(["pr", "SP"])).select("cnpj", "uf")


@query
def f3_large_cities(i: Inputs) -> DataFrame:
    kept = filters.in_large_cities(_branches(i), i.population, 200_000)
    return kept.select("cnpj", "municipio")


@query
def f4_trade_name(i: Inputs) -> DataFrame:
    return _branches(i).filter(R.has_trade_name(F.col("nome_fantasia"))).select("cnpj")


@query
def f5_phone(i: Inputs) -> DataFrame:
    valid = R.has_valid_phone(F.col("ddd1"), F.col("telefone1"))
    return _branches(i).filter(valid).select("cnpj", "ddd1", "telefone1")


@query
def f6_cnaes(i: Inputs) -> DataFrame:
    """Main activity alone, and with secondary activities."""
    wanted = ("4781400", "0111301")
    main, either = filters.in_cnaes(wanted), filters.in_cnaes(wanted, with_secondary=True)
    return _branches(i).filter(either).select("cnpj", main.alias("principal"))


@query
def f7_branch_filter(i: Inputs) -> DataFrame:
    rules = filters.BranchFilter(
        states=("PR", "SP", "MG"), secondary_cnaes=True, require_trade_name=True,
        require_phone=True, min_population=K.LARGE_CITY,
    )
    return filters.filter_branches(_branches(i), rules, i.population).select("cnpj")


@query
def f8_follow_branches(i: Inputs) -> DataFrame:
    accepted = _branches(i).filter(filters.branch_condition(filters.BranchFilter()))
    partners = i.registry["socios"].select("id", "cnpj_basico")
    return filters.follow_branches(partners, accepted, ["id"]).select("id", "cnpj_basico")


@query
def f9_lookup(i: Inputs) -> DataFrame:
    return filters.restrict_lookup(i.registry["cnaes"], K.RETAIL_CNAES).select("codigo", "descricao")


@query
def f10_retail(i: Inputs) -> DataFrame:
    return _branches(i).filter(filters.is_retail()).select("cnpj", "cnae_fiscal_principal")


@query
def f11_acceptance(i: Inputs) -> DataFrame:
    named = F.concat(F.lit("Estabelecimentos"), "motivo_situacao_cadastral", F.lit(".zip"))
    rows = _branches(i).withColumn("file_name", named)
    return filters.acceptance_report(
        rows, filters.branch_condition(filters.BranchFilter()), "file_name"
    ).withColumn("taxa", F.round("taxa", 6))


# --- Joins ------------------------------------------------------------------------------------


_COMPLETE_TEXT = (
    "razao_social", "nome_fantasia", "natureza_juridica", "natureza_juridica_descricao", "porte",
    "situacao_cadastral", "cnae_fiscal_principal", "cnae_principal_descricao", "logradouro", "cep",
    "uf", "municipio", "municipio_descricao", "telefone_1", "telefone_2", "email",
    "opcao_simples", "opcao_mei", "source_competence",
)


@query
def j1_complete_companies(i: Inputs) -> DataFrame:
    return i.complete.select(
        "cnpj", "cnpj_basico", *filled(*_COMPLETE_TEXT), *filled("data_inicio_atividade"),
        F.coalesce(money("capital_social"), F.lit(-1.0)).alias("capital_social"),
    )


@query
def j2_retail_branches(i: Inputs) -> DataFrame:
    return views.retail_branches(i.complete, i.population).select(
        "cnpj", "nome_fantasia", "uf", "municipio", "telefone_1", "municipio_populacao",
        "municipio_pop_ano",
    )


@query
def j3_candidates(i: Inputs) -> DataFrame:
    return views.prospect_candidates(i.complete).select(
        "cnpj", "cnae_fiscal_principal", *filled("email", "razao_social")
    )


@query
def j4_prospect_digital(i: Inputs) -> DataFrame:
    retail = views.retail_branches(i.complete, i.population)
    return views.prospect_digital(retail, i.state).select(
        "cnpj", "uf", *filled("enrich_status", "plataforma", "digital_score", "decisor_nome"),
        F.coalesce(F.date_format("digital_enriched_at", "yyyy-MM-dd"), F.lit("")).alias("dia"),
    )


@query
def j5_qualification_input(i: Inputs) -> DataFrame:
    return leads.qualification_input(i.candidates, i.state).select(
        "cnpj", "enrich_status", *filled("email", "email_original", "lead_score")
    )


@query
def j6_rescore_input(i: Inputs) -> DataFrame:
    return views.rescore_input(i.state, i.candidates, "v2").select(
        "cnpj", *filled("score_version", "cnae_fiscal_principal")
    )


@query
def j7_queue_input(i: Inputs) -> DataFrame:
    return views.queue_input(i.candidates, i.state).select(
        "cnpj", *filled("has_state", "enrich_status", "enrich_attempts", "google_place_id")
    )


# What the matching of sites and the overlay of providers read of a profile.
_PROFILE_COLUMNS = (
    "cnpj", "nome_fantasia", "razao_social", "uf", "municipio_descricao", "telefone_1", "email_tipo",
    "email_dominio", "domain_shared_count", "site_url", "site_source", "faturamento_estimado",
    "faturamento_estimado_fonte", "decisor_nome",
)


def _profiles(i: Inputs) -> DataFrame:
    return enrich.profile(i.candidates, i.registry["socios"], i.providers).select(*_PROFILE_COLUMNS)


def _profiled(i: Inputs) -> DataFrame:
    """Profiles saved, since the attempts read them twice; no other column is moved or written."""
    return i.saved("profiled", lambda: _profiles(i))


def _attempts(i: Inputs) -> DataFrame:
    return enrich.match_sites(_profiled(i), i.facts)


@query
def j8_site_candidates(i: Inputs) -> DataFrame:
    """Every URL tried per company and the page it leads to."""
    tried = sites.site_candidates(_profiled(i))
    found = sites.join_pages(tried, i.facts.select("url_key", "page_id", "status"))
    return found.select(
        "cnpj", "attempt", "candidate_url", "candidate_source", "page_id", *filled("status")
    )


@query
def j8_refetched_pages(i: Inputs) -> DataFrame:
    """Every URL tried per company and the latest of several fetches of its page."""
    page = i.facts.select("url_key", "page_id", "url", "status", F.lit("").alias("content"))

    def fetched(days: Column) -> Column:
        return F.timestamp_seconds((F.col("page_id") * days) % 1000 * 86400)

    log = page.withColumn("fetched_at", fetched(F.lit(7919))).unionByName(
        page.withColumns({
            "fetched_at": fetched(F.lit(104729)),
            "page_id": -F.col("page_id"),
            "status": F.lit(404).cast(page.schema["status"].dataType),
        })
    )
    latest = sites.latest_fetches(log).select("url_key", "page_id", "status")
    found = sites.join_pages(sites.site_candidates(_profiled(i)), latest)
    return found.select("cnpj", "attempt", "candidate_url", "page_id", *filled("status"))


@query
def j9_place_scores(i: Inputs) -> DataFrame:
    return sites.place_scores(i.places, i.candidates, hot_rows=None).select(
        "cnpj", "place_id", "match_score"
    )


@query
def j10_provider_overlay(i: Inputs) -> DataFrame:
    return _profiles(i).select(
        "cnpj", *filled("site_url", "site_source", "faturamento_estimado",
                        "faturamento_estimado_fonte", "decisor_nome"),
    )


# --- Aggregations -----------------------------------------------------------------------------


@query
def a1_status_counts(i: Inputs) -> DataFrame:
    return reports.counts_by(i.state, "enrich_status", keep_null=True)


@query
def a1_kept_counts(i: Inputs) -> DataFrame:
    """Status counts kept by the changes of a merge instead of a recount."""
    columns = ["cnpj", "cnpj_basico", "enrich_status", "lead_score"]
    base = changes.hashed(i.state.select(*columns), "cnpj")
    counted = reports.counts_by(base, "enrich_status", keep_null=True)
    closed = i.registry["estabelecimentos"].filter("situacao_cadastral = '08'").select(
        "cnpj", "cnpj_basico", F.lit("done").alias("enrich_status"), F.lit(77).alias("lead_score"))
    merged = changes.merge_changes(base, closed, "cnpj", i.now)
    return changes.apply_deltas(counted, changes.count_deltas(merged, "enrich_status"), "enrich_status")


@query
def a2_valid_contacts(i: Inputs) -> DataFrame:
    return reports.valid_contact_counts(i.state)


@query
def a3_maturity_counts(i: Inputs) -> DataFrame:
    """Counts of three maturities, one section each."""
    return reports.section_counts(i.state, "commerce_maturity", "presence_maturity", "lead_classification")


@query
def a4_top_platforms(i: Inputs) -> DataFrame:
    return reports.top_platforms(i.state, 10)


@query
def a5_qualification_counts(i: Inputs) -> DataFrame:
    return reports.counts_by(leads.qualify(i.candidates, i.state), "qualification_status")


@query
def a6_shared_domains_batch(i: Inputs) -> DataFrame:
    """One state's companies as a batch, the others as the stored state."""
    rows = contacts.email_profile(i.candidates)
    batch = rows.filter("uf = 'PR'").select("cnpj", "email_dominio")
    stored = rows.filter("uf <> 'PR' OR uf IS NULL OR cnpj LIKE '%7'").select("cnpj", "email_dominio")
    return contacts.shared_domain_counts(batch, stored=stored).select(
        "cnpj", *filled("email_dominio"), "domain_shared_count", "domain_is_shared"
    )


@query
def a6_shared_domains(i: Inputs) -> DataFrame:
    rows = contacts.email_profile(i.candidates).select("cnpj", "email_dominio")
    return contacts.shared_domain_counts(rows).select(
        "cnpj", *filled("email_dominio"), "domain_shared_count", "domain_is_shared"
    )


def _merged_flags() -> list[Column]:
    return [F.coalesce(F.col(f), F.lit(False)).alias(f) for f in (*P.FLAGS, "has_chat")]


@query
def a7_merge_signals(i: Inputs) -> DataFrame:
    """All pages of a site merged in page order."""
    merged = pages.merge_signals(i.facts, "host", "page_id")
    return merged.select(
        "host", *_merged_flags(), "plataforma_confianca", *filled("chat_provider", "plataforma"),
        listed("plataformas_detectadas"),
    )


@query
def a8_run_stats(i: Inputs) -> DataFrame:
    return reports.run_stats(i.raw("attempts"))


@query
def a9_large_cities(i: Inputs) -> DataFrame:
    return reports.large_city_count(i.population)


@query
def a10_year_rows(i: Inputs) -> DataFrame:
    """Rows of a year that is loaded and of one that is not."""
    return reports.year_count(i.population, YEAR).unionByName(
        reports.year_count(i.population, YEAR - 1)
    )


# --- Windows, sorts, limits -------------------------------------------------------------------


@query
def w1_decision_makers(i: Inputs) -> DataFrame:
    return contacts.decision_makers(i.registry["socios"])


@query
def w2_last_row_wins(i: Inputs) -> DataFrame:
    """Latest partner row per company and qualification (a company may have very many)."""
    rows = i.registry["socios"].withColumn(
        "chave", F.concat_ws("-", "cnpj_basico", "qualificacao_socio")
    )
    latest = upsert.latest_per_key(rows, "chave", ["data_entrada_sociedade", "id"])
    return latest.select("chave", "id", "nome_socio_razao_social")


@query
def w3_platform_ranking(i: Inputs) -> DataFrame:
    """Platforms of each page, best first, with their confidences."""
    ranked = i.site_pages.withColumn("_lower", F.lower("html")).select(
        "page_id", P.platforms(F.col("html"), F.col("_lower")).alias("p")
    )
    text = F.transform("p", lambda x: F.concat_ws(":", x["name"], x["confidence"].cast("string")))
    return ranked.select("page_id", F.array_join(text, "|").alias("plataformas"))


@query
def w4_best_places(i: Inputs) -> DataFrame:
    best = sites.best_places(sites.place_scores(i.places, i.candidates, hot_rows=None))
    return best.select(
        "cnpj", "google_place_match_score", *filled("place_id", "website", "business_status")
    )


@query
def w5_best_attempts(i: Inputs) -> DataFrame:
    """The deciding attempt of every company over the whole attempt log, however long."""
    log = i.raw("attempts").withColumns(
        {
            "attempt": F.col("event_id"),
            "site_valid": (F.col("status") == 200) & (F.col("value") > 90),
            "site_match_status": F.when(
                (F.col("status") == 200) & (F.col("value") < 1), "rejected_webmail"
            ),
        }
    )
    return sites.best_attempts(log, ["status", "value"])


@query
def w5_decided_sites(i: Inputs) -> DataFrame:
    """The enrichment's own rule over the whole attempt log: site, match and error of every company."""
    status, value = F.col("status"), F.col("value")
    match = F.when(value < 1, "rejected_webmail").when(value > 90, "validated").otherwise("weak")
    log = i.raw("attempts").withColumns(
        {
            "attempt": F.col("event_id"),
            "candidate_url": F.concat(F.lit("https://site"), "event_id"),
            "site_valid": (status == 200) & (value > 90),
            "site_match_status": F.when(status == 200, match),
            "site_match_score": value,
            "fetch_error": F.when(status.isNull() | (status == 429), F.col("enrich_status")),
            "cnpj_on_site": value.between(50, 55),
        }
    )
    others = [c for c in enrich.ATTEMPT_FIELDS if c not in log.columns]
    log = log.withColumns({c: F.lit(None).cast("string") for c in others})
    return enrich.decide_sites(log).select(
        "cnpj", "answered", "status", "site_match_score", "cnpj_on_site",
        *filled("candidate_url", "site_match_status", "fetch_error"),
    )


@query
def l1_outreach_legacy(i: Inputs) -> DataFrame:
    merged = upsert.merge_qualification(_history(i), leads.qualify(i.candidates, i.state), i.now)
    return leads.outreach_legacy(merged).select(
        "cnpj", *filled("digital_score"), moment("qualified_at")
    )


def _qualified(i: Inputs) -> DataFrame:
    rows = leads.qualify(i.candidates, i.state)
    return rows.withColumns({"last_qualified_at": i.now, "updated_at": i.now})


@query
def l2_outreach(i: Inputs) -> DataFrame:
    return leads.outreach(_qualified(i)).select(
        "cnpj", *filled("site_final_url", "lead_score", "confidence_score", "contact_channel",
                        "contact_value", "whatsapp_url"),
        "qualification_status",
    )


@query
def l3_newest_active(i: Inputs) -> DataFrame:
    return views.newest_active(i.complete, "PR", "4781400").select(
        "cnpj", *filled("razao_social", "nome_fantasia", "telefone_1", "email", "uf",
                        "data_inicio_atividade"),
    )


@query
def l4_keyset_batch(i: Inputs) -> DataFrame:
    waiting = queue.pending(views.queue_input(i.candidates, i.state), i.now)
    closed = i.state.filter("enrich_status = 'done'")
    batch = queue.keyset_batch(waiting, 300, after="00000200", exclude=closed)
    return batch.select("cnpj", *filled("enrich_status"))


@query
def l5_recent_runs(i: Inputs) -> DataFrame:
    runs = i.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("competence"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"),
        F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("finished_at"),
        F.lit(10).alias("files_processed"), F.col("o_custkey").alias("rows_processed"),
    )
    return reports.recent_runs(runs, 500).select(
        "id", "competence", "status", "rows_processed"
    )


@query
def l6_qualified_list(i: Inputs) -> DataFrame:
    return leads.qualified_list(_qualified(i)).select(
        "cnpj", "qualification_status", *filled("lead_score", "contact_channel")
    )


# --- Contacts ---------------------------------------------------------------------------------


@query
def c1_email_profile(i: Inputs) -> DataFrame:
    return contacts.email_profile(i.registry["estabelecimentos"], "correio_eletronico").select(
        "cnpj", *filled("email_dominio", "email_normalizado"), "email_tipo"
    )


@query
def c2_email_role(i: Inputs) -> DataFrame:
    return i.registry["estabelecimentos"].select(
        "cnpj", C.email_role(F.col("correio_eletronico")).alias("papel")
    )


@query
def c3_phones(i: Inputs) -> DataFrame:
    phone = R.phone_text(F.col("ddd1"), F.col("telefone1"))
    return i.registry["estabelecimentos"].select(
        "cnpj", F.coalesce(C.normalize_phone(phone), F.lit("")).alias("telefone")
    )


@query
def c4_whatsapp_candidates(i: Inputs) -> DataFrame:
    link = C.whatsapp_candidate(F.col("telefone_1"))
    return i.candidates.select("cnpj", link.alias("link")).filter(F.col("link").isNotNull())


@query
def c5_whatsapp_links(i: Inputs) -> DataFrame:
    found = i.site_pages.select(
        "page_id", P.whatsapp_link(F.col("html"), F.col("url")).alias("w")
    )
    return found.select(
        "page_id", "w.detected", "w.valid", "w.confidence",
        *[F.coalesce(f"w.{n}", F.lit("")).alias(n) for n in ("number", "normalized", "canonical_url")],
    )


@query
def c6_social_links(i: Inputs) -> DataFrame:
    html, url = F.col("html"), F.col("url")
    return i.site_pages.select(
        "page_id",
        F.coalesce(P.social_link(html, url, "instagram.com"), F.lit("")).alias("instagram"),
        F.coalesce(P.social_link(html, url, "linkedin.com"), F.lit("")).alias("linkedin"),
    )


@query
def c7_contact_channel(i: Inputs) -> DataFrame:
    rows = leads.with_channel(leads.qualification_input(i.candidates, i.state))
    return rows.select(
        "cnpj", *filled("contact_channel", "contact_value"), "contact_confidence", "contact_role"
    )


# --- Pages ------------------------------------------------------------------------------------


def _signals(i: Inputs) -> DataFrame:
    """Signals of all pages, whatever their fetch outcome."""
    return i.saved("signals", lambda: pages.page_signals(i.site_pages))


@query
def g1_platforms(i: Inputs) -> DataFrame:
    return _signals(i).select(
        "page_id", *filled("plataforma"), "plataforma_confianca", listed("plataformas_detectadas")
    )


@query
def g2_chat(i: Inputs) -> DataFrame:
    return _signals(i).select("page_id", "has_chat", *filled("chat_provider"))


@query
def g3_commerce_flags(i: Inputs) -> DataFrame:
    return _signals(i).select("page_id", *P.FLAGS)


@query
def g4_site_rollup(i: Inputs) -> DataFrame:
    rollup = pages.site_rollup(_signals(i))
    return rollup.select(
        "host", *_merged_flags(), "plataforma_confianca", *filled("chat_provider", "plataforma"),
        listed("plataformas_detectadas"),
    )


@query
def g5_page_merge(i: Inputs) -> DataFrame:
    """Landing pages with what the inner pages of their site add."""
    landing = _signals(i).filter(pages.visit_order(F.col("url")) == 0).withColumn(
        "site_valid", F.col("page_id") % 3 != 0
    )
    merged = enrich.merge_rollup(landing, pages.site_rollup(_signals(i)))
    return merged.select(
        "page_id", *_merged_flags(), "plataforma_confianca", *filled("chat_provider", "plataforma"),
        listed("plataformas_detectadas"),
    )


@query
def g6_strong_commerce(i: Inputs) -> DataFrame:
    return _signals(i).select("page_id", P.strong_commerce(F.col).alias("forte"))


@query
def g7_titles(i: Inputs) -> DataFrame:
    return i.table("pages").select("page_id", P.title(F.col("html")).alias("titulo"))


@query
def g8_hosts(i: Inputs) -> DataFrame:
    return i.table("pages").select("page_id", urls.site_host(F.col("url")).alias("host"))


@query
def g9_site_ownership(i: Inputs) -> DataFrame:
    return _attempts(i).filter(F.col("site_match_score").isNotNull()).select(
        "cnpj", "attempt", "site_match_score", "site_match_status",
        listed("site_validation_reasons"),
    )


@query
def g10_site_validity(i: Inputs) -> DataFrame:
    """Validity of every read page at a lower threshold; the status rule still holds."""
    scored = enrich.match_sites(_profiled(i), i.facts, threshold=40)
    read = scored.filter(F.col("site_match_score").isNotNull())
    return read.select("cnpj", "attempt", "site_valid", "cnpj_on_site")


@query
def g11_fetch_outcome(i: Inputs) -> DataFrame:
    return pages.fetch_outcome(i.site_pages).select(
        "page_id", "reachable", "has_html",
        *filled("fetch_error", "retry_after_days", "retry_after_hours"),
    )


@query
def g12_unsafe_urls(i: Inputs) -> DataFrame:
    """Page URLs rewritten to all kinds of unsafe addresses."""
    host = urls.hostname(F.col("url"))
    n = F.col("page_id")
    last = (n % 256).cast("string")
    variants = [
        F.col("url"),
        F.concat(F.lit("ftp://"), host, F.lit("/")),
        F.concat(F.lit("https://user:pw@"), host, F.lit("/")),
        F.concat(F.lit("http://127.0.0."), last, F.lit("/x")),
        F.concat(F.lit("http://10."), last, F.lit(".1.2:8080/")),
        F.concat(F.lit("http://172."), last, F.lit(".0.1/")),
        F.concat(F.lit("http://8.8."), last, F.lit(".8/")),
        F.concat(F.lit("http://"), (F.lit(2130706432) + n % 256).cast("string"), F.lit("/")),
        F.lit("http:///sem-host"),
        F.lit("http://LOCALHOST/"),
        F.concat(F.lit("http://224.0."), last, F.lit(".1")),
        F.concat(F.lit("http://169.254."), last, F.lit(".254/latest?x=1")),
    ]
    chosen = F.element_at(F.array(*variants), (n % len(variants) + 1).cast("int"))
    rows = i.table("pages").select("page_id", chosen.alias("url"))
    return urls.flag_unsafe(rows).select("page_id", *filled("unsafe_reason"))


@query
def g13_enrich_status(i: Inputs) -> DataFrame:
    rows = i.state.withColumns(
        {
            "has_html": F.col("site_http_status") == 200,
            "site_url": F.when(F.col("site_ativo"), F.col("site_url")),
        }
    )
    return leads.enrich_status(rows).select("cnpj", "enrich_status")


# --- Scores and qualification -----------------------------------------------------------------


def _scored(i: Inputs, **rules) -> DataFrame:
    return leads.score_leads(i.state, **rules)


@query
def q1_presence(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", "presence_score", "presence_maturity")


@query
def q2_commerce(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", "commerce_score", "commerce_maturity")


@query
def q3_fit(i: Inputs) -> DataFrame:
    scored = _scored(i, priority_cnaes=("4781400", "4791201"), mei_penalty=15)
    return scored.select("cnpj", "fit_score")


@query
def q4_pain(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", "pain_score")


@query
def q5_confidence(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", "confidence_score")


@query
def q6_lead(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", "lead_score", "lead_classification")


@query
def q7_all_scores(i: Inputs) -> DataFrame:
    return _scored(i).select("cnpj", *leads.SCORE_COLUMNS)


@query
def q8_rescore(i: Inputs) -> DataFrame:
    rescored = leads.rescore(i.state, i.candidates, i.now)
    return rescored.select(
        "cnpj", "fit_score", "lead_score", "digital_score", "score_version", moment("updated_at")
    )


@query
def q9_qualification(i: Inputs) -> DataFrame:
    rows = leads.with_channel(leads.qualification_input(i.candidates, i.state))
    return leads.evaluate_qualification(rows, 50, 40).select(
        "cnpj", "qualification_status", listed("rejection_reasons"),
        listed("qualification_reasons"),
    )


@query
def q10_qualified_rows(i: Inputs) -> DataFrame:
    return leads.qualify(i.candidates, i.state).select(
        "cnpj", "qualification_status", "qualification_version",
        *filled("whatsapp_url", "digital_score", "digital_maturity", "faixa_faturamento_estimada",
                "contact_value"),
    )


# --- Queue and increments ---------------------------------------------------------------------


@query
def r1_pending(i: Inputs) -> DataFrame:
    waiting = queue.pending(views.queue_input(i.candidates, i.state), i.now)
    return waiting.select("cnpj", *filled("enrich_status", "enrichment_version"))


@query
def r2_next_retry(i: Inputs) -> DataFrame:
    rows = i.state.withColumns(
        {
            "retry_after_days": F.when(F.col("enrich_attempts") == 1, 30),
            "retry_after_hours": F.when(F.col("enrich_attempts") == 2, F.col("lead_score")),
        }
    )
    return queue.next_retry(rows, i.now).select(
        "cnpj", F.coalesce(moment("next_retry_at"), F.lit("")).alias("next_retry_at")
    )


@query
def r3_requeue(i: Inputs) -> DataFrame:
    marked = queue.requeue(i.state, i.now)
    return marked.select(
        "cnpj", "requeued", "enrich_status", *filled("enrichment_version", "retry_reason"),
        F.coalesce(moment("next_retry_at"), F.lit("")).alias("next_retry_at"),
    )


@query
def r4_attempts(i: Inputs) -> DataFrame:
    return queue.count_attempt(i.state).select("cnpj", "enrich_attempts")


@query
def r5_cached_places(i: Inputs) -> DataFrame:
    fresh = queue.place_is_cached(i.now)
    return i.state.select("cnpj", fresh.alias("em_cache"))


@query
def r7_stream_ingest(i: Inputs) -> DataFrame:
    """Three releases of company files arrive; the stream loads each file once."""
    incoming = new_folder(i.spark, "incoming")
    log, checkpoint = new_folder(i.spark, "log"), new_folder(i.spark, "stream")
    raw = i.raw("raw_empresas")
    changed = raw.withColumn("porte", F.lit("05")).filter("natureza_juridica > '0010'")
    for release, rows in (
        ("2026-06", raw),
        ("2026-07", changed.withColumn("razao_social", F.lit("Julho SA"))),
        ("2026-05", raw.withColumn("razao_social", F.lit("Antiga"))),
    ):
        registry_files.write_delimited(rows, "Empresas", f"{incoming}/{release}")
        stream.start_ingest(i.spark, "Empresas", incoming, log, checkpoint).awaitTermination()
    table = stream.current_table(i.spark, "Empresas", log)
    return table.select("cnpj_basico", *filled("razao_social", "porte"), "source_competence")


# --- Whole jobs -------------------------------------------------------------------------------


@query
def ingest_release(i: Inputs) -> DataFrame:
    """A whole release load: branches filtered, companies following them, merged and counted."""
    rules = filters.BranchFilter(require_phone=True)
    raw = {
        kind: i.raw(name, spread=True).withColumns(
            {"file_name": F.lit(f"{kind}.zip"), "block_start": F.lit(0), "row_id": F.lit(0)}
        )
        for kind, name in (
            ("Estabelecimentos", "raw_estabelecimentos"), ("Empresas", "raw_empresas"),
            ("Socios", "raw_socios"), ("Cnaes", "raw_cnaes"),
        )
    }
    load = ingest.load_dataset(
        "Estabelecimentos", raw["Estabelecimentos"], None, COMPETENCE, i.now, rules
    )
    branches = i.saved("loaded_branches", lambda: load.table)
    counts = branches.agg(F.count(F.lit(1)).alias("linhas")).select(
        F.lit("estabelecimentos").alias("tabela"), "linhas"
    )
    for kind, source in (("Empresas", "customer"), ("Socios", "lineitem"), ("Cnaes", "nation")):
        # As many parts as the rows that follow the roots are to be sorted in.
        roots = branches.select("cnpj_basico").repartition(i.dealt_parts(source), "cnpj_basico")
        table = ingest.load_dataset(
            kind, raw[kind], None, COMPETENCE, i.now, rules, branches=roots, hot_roots=i.hot_partner_roots()
        ).table
        counts = counts.unionByName(
            table.agg(F.count(F.lit(1)).alias("linhas")).select(
                F.lit(DATASETS[kind].table).alias("tabela"), "linhas"
            )
        )
    return counts


def _enriched(i: Inputs) -> DataFrame:
    def save(name: str, rows: DataFrame) -> DataFrame:
        store = i.saved_by_branch if "cnpj" in rows.columns else i.saved
        return store(f"enrich_{name}", lambda: rows)

    return i.saved_by_branch(
        "enriched",
        lambda: enrich.enrich(
            i.candidates_by_branch, i.partners_by_root, i.facts, i.now, i.providers, i.places,
            save=save, lay=i.lay,
        ),
    )


@query
def enrich_candidates(i: Inputs) -> DataFrame:
    """The enrichment state of every candidate, from contacts, places, providers and pages."""
    return _enriched(i).select(
        "cnpj", "email_tipo", "domain_shared_count", "enrich_status", "site_valid",
        "site_reachable", "site_match_score", "google_place_match_score", "whatsapp_valid",
        "plataforma_confianca", "presence_score", "commerce_score", "fit_score", "pain_score",
        "confidence_score", "lead_score", "enrich_attempts",
        *filled("decisor_nome", "site_url", "site_source", "site_match_status", "plataforma",
                "instagram_url", "whatsapp_number_normalized", "telefone_candidato_whatsapp",
                "fetch_error", "commerce_maturity", "lead_classification"),
        listed("site_validation_reasons"),
        F.coalesce(moment("next_retry_at"), F.lit("")).alias("next_retry_at"),
    )


@query
def qualified_leads(i: Inputs) -> DataFrame:
    """The end of the chain: new enrichment qualified and counted by status and channel."""
    rows = leads.qualify(i.candidates_by_branch, _enriched(i))
    return rows.groupBy(
        "qualification_status", *filled("contact_channel")
    ).agg(F.count(F.lit(1)).alias("total"), F.sum("lead_score").alias("soma_lead"))

"""The derived inputs: in parts that follow the size of the given tables, by root only where a query asks for it."""

import os

import pytest
from pyspark.sql import functions as F

from fichario.catalog import inputs
from fichario.catalog.inputs import Inputs
from fichario.catalog.queries import QUERIES
from fichario.functions.text import held
from fichario.operators import by_root, sites

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(inputs, "PART_BYTES", 5_000)
    for kept in ("_SAVED", "_ROOTS", "_HOT"):
        monkeypatch.setattr(inputs, kept, {})


def test_parts_follow_the_size_of_the_table(spark, small_parts):
    i = Inputs(spark, FOLDER)
    wanted = -(-os.path.getsize(f"{FOLDER}/lineitem.parquet") // 5_000)
    assert wanted > spark.sparkContext.defaultParallelism
    assert i.spread_table("lineitem").rdd.getNumPartitions() == wanted
    plan = i.raw("raw_socios", spread=True)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan  # that sorts all rows first
    files = i.registry.roots["simples"].cold.inputFiles()  # one per bucket that has rows
    assert spark.sparkContext.defaultParallelism < len(files) <= wanted


@pytest.mark.parametrize("name", ["c2_email_role", "f8_follow_branches", "w1_decision_makers", "a5_qualification_counts"])
def test_one_time_use_stores_nothing_by_root(spark, small_parts, monkeypatch, name):
    def store(*_):
        raise AssertionError("stored by root")

    monkeypatch.setattr(by_root, "store", store)
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_a_companys_names_are_prepared_before_they_meet_its_places(spark):
    """Patterns over the company's columns stand below the join, once per company and not per place."""
    i = Inputs(spark, FOLDER)
    scored = sites.place_scores(i.places, i.candidates)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join Inner")]
    assert "razao_social" not in above and "municipio_descricao" not in above and "display_name" in above


def test_messages_of_an_audit_are_not_broadcast(spark):
    """Few bytes on disk may be many messages: no task may hold those of all files."""
    plan = QUERIES["s17_load_audit"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_filters_work_above_the_move_and_not_in_the_few_reading_tasks(spark):
    """A row group cannot be cut, so all rows of a file may be read by one task, whatever the number of parts."""
    wide = Inputs(spark, FOLDER).registry["estabelecimentos"].filter("situacao_cadastral = '02'").select("cnpj")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan[: plan.index("RepartitionByExpression")], plan[plan.index("RepartitionByExpression"):]
    assert "= 02" in above and "= 02" not in below
    assert "o_comment" not in below  # columns that nobody asks for are not moved


def test_a_table_read_in_many_parts_is_moved_all_the_same(spark, monkeypatch):
    """Parts of a file without a row group of their own are empty: their number does not show where rows lie."""
    monkeypatch.setattr(inputs, "PART_BYTES", 1 << 40)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        i = Inputs(spark, FOLDER)
        assert i.table("orders").rdd.getNumPartitions() >= i.parts("orders")
        held = [len(part) for part in i.spread_table("orders").select("o_orderkey").rdd.glom().collect()]
        assert sum(n > 0 for n in held) > spark.sparkContext.defaultParallelism // 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_profiles_are_saved_without_columns_that_no_site_is_matched_by(spark):
    from fichario.catalog import queries

    saved = queries._profiled(Inputs(spark, FOLDER)).columns
    assert "domain_shared_count" in saved and not {"logradouro", "capital_social", "email_papel"} & set(saved)


def _plan(rows, kind="executedPlan"):
    return getattr(rows._jdf.queryExecution(), kind)().toString()


def test_stored_state_is_not_moved_again_to_meet_its_candidates(spark):
    """Few narrow columns of it are dealt by its key; the wide rows then lie where the joins want them."""
    i = Inputs(spark, FOLDER)
    i.candidates
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["l1_outreach_legacy"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 2
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(cnpj" in line]
    assert sum("ENSURE_REQUIREMENTS" in line for line in moved) == 1  # the candidates alone


@pytest.mark.parametrize("name", ["l1_outreach_legacy", "l2_outreach", "l6_qualified_list"])
def test_rows_of_a_total_sort_are_made_once(spark, name):
    plan = _plan(QUERIES[name](spark, FOLDER))
    below = plan[plan.index("Exchange rangepartitioning"):]
    assert "REPARTITION_BY_COL" in below[:below.index("Join")]


@pytest.mark.parametrize("name", ["w1_decision_makers", "w2_last_row_wins"])
def test_no_column_is_read_for_the_deal_alone(spark, name):
    assert "l_orderkey" not in _plan(QUERIES[name](spark, FOLDER))


def test_filters_by_a_made_status_hold_no_copy_of_its_rules(spark):
    plan = _plan(QUERIES["l6_qualified_list"](spark, FOLDER), "optimizedPlan")
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert any("= qualified" in line for line in filters)
    assert not any("= qualified" in line and "rejected_webmail" in line for line in filters)


def test_an_enrichment_moves_no_wide_row_to_its_partners_domains_and_places(spark):
    """Only keys, and what is found by them, are moved; partners are read once and grouped where they are dealt."""
    from fichario.plans import enrich

    i = Inputs(spark, FOLDER)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "23"}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        profiled = enrich.profile(
            i.candidates_by_branch, i.partners_by_root, i.providers, i.places, now=i.now, lay=i.lay)
        lines = _plan(profiled).splitlines()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    scans = [line for line in lines if "FileScan" in line]
    assert sum("l_partkey" in line for line in scans) == 1
    wide = next(n for n, line in enumerate(lines) if "FileScan" in line and "capital_social" in line)
    assert "Bucketed: true" in lines[wide]
    depth = lines[wide].index("FileScan")
    for line in reversed(lines[:wide]):  # up the branch of the plan that reads the wide rows
        at = next(k for k, c in enumerate(line) if c.isalpha())
        if at < depth:
            depth = at
            assert not line[at:].startswith("Exchange"), line[:200]
    grouped = [line for line in lines if "Exchange hashpartitioning(cnpj#" in line and "ENSURE_REQUIREMENTS" in line]
    assert len(grouped) == 1  # the best place of each company, after the Python that compares names


def test_partners_of_a_release_move_once_and_are_hashed_where_they_meet_their_root(spark):
    """No row counts or salts where no root is hot, no hash of a row is moved, and ids need no move of their own."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["ingest_release"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("l_partkey") and "_salt" not in plan
    partners = plan[plan.index("Window [row_number() windowspecdefinition(cnpj_basico#", plan.index("id#") - 200):]
    assert "Exchange hashpartitioning(id#" not in plan
    assert "sha2(" in partners[: partners.index("SortMergeJoin")]
    joined = partners[partners.index("SortMergeJoin"):]
    assert "sha2(" not in joined


def test_a_hot_root_is_followed_with_the_same_rows(spark):
    """Hot roots known: spread as before; none: plain; either way the rows of unclean roots are cleaned and kept."""
    from pyspark.sql import functions as F

    from fichario.operators.filters import BranchFilter
    from fichario.plans import ingest

    i = Inputs(spark, FOLDER)
    raw = i.raw("raw_socios").limit(500).withColumn("cnpj_basico", F.concat(F.lit("  "), "cnpj_basico", F.lit(" ")))
    raw = raw.unionByName(raw).withColumn("file_name", F.lit("Socios.zip"))  # every id twice
    branches = i.raw("raw_socios").limit(300).select("cnpj_basico")
    found = []
    for hot in (None, [], ["00000001"]):
        table = ingest.load_dataset("Socios", raw, None, "2026-07", i.now, BranchFilter(), branches=branches, hot_roots=hot).table
        found.append(sorted(map(tuple, table.select("cnpj_basico", "id", "nome_socio_razao_social").collect())))
    assert found[0] and found[0] == found[1] == found[2]
    assert len({row[1] for row in found[0]}) == len(found[0]) and all(row[0] == row[0].strip() for row in found[0])


def test_candidate_urls_and_reasons_are_listed_by_compiled_code(spark):
    """A filter of an array is evaluated case by case, without compiled code, for every row."""
    from fichario.plans import enrich

    i = Inputs(spark, FOLDER)
    rows = i.candidates_by_branch.select(
        "*", *[F.lit("x").alias(c) for c in ("site_url", "site_source", "email_dominio", "email_tipo")],
        F.lit(1).alias("domain_shared_count"))
    for made in (sites.site_candidates(rows), enrich.match_sites(rows, i.facts)):
        assert "lambdafunction" not in _plan(made)


def test_held_lists_what_holds_in_order(spark):
    rows = spark.createDataFrame([(1, "a"), (5, "b"), (None, None)], "n int, t string")
    got = rows.select(held((F.col("n") > 0, F.col("t")), (F.col("n") > 3, F.lit("big")), (F.col("n").isNull(), F.lit("none"))).alias("x"))
    assert [r.x for r in got.collect()] == [["a"], ["b", "big"], ["none"]]

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fichario.operators import filters, queue, skew, upsert, views
from fichario.plans import ingest
from fichario.schemas import DATASETS
from fichario.session import new_folder
from fichario.sources import population, registry_files, releases
from fichario.streaming import releases as stream


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


COMPANY_LINE = '"{}";"{}";"2062";"49";"1.000,00";"03";""\n'


def test_delimited_rows(spark, tmp_path):
    text = COMPANY_LINE.format("1", 'Padaria ""São"" João; e\nfilhos') + '"2";"curta"\n' + (
        '"3";"longa";"a";"b";"c";"d";"e";"extra"\n')
    (tmp_path / "empresas.csv").write_bytes(text.encode("latin-1"))
    rows = registry_files.read_delimited(spark, str(tmp_path), "Empresas")
    got = {r.cnpj_basico: r for r in rows.collect()}
    assert got["1"].razao_social == 'Padaria "São" João; e\nfilhos'
    assert got["2"].razao_social == "curta" and got["2"].porte is None
    assert got["3"].ente_federativo_responsavel == "e" and got["3"].file_name == "empresas.csv"


def test_zipped_rows(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Empresas0.zip", "w") as archive:
        archive.writestr("pasta/", "")
        lines = "".join(COMPANY_LINE.format(n, 'a""b\nc') for n in range(45_000))
        archive.writestr("pasta/F.EMPRECSV", (lines + '"x";"curta"\n').encode("latin-1"))
        archive.writestr("pasta/outra", "ignored")
    (tmp_path / "copy.zip").write_bytes((tmp_path / "Empresas0.zip").read_bytes())
    paths = [f"file://{tmp_path}/Empresas0.zip", f"{tmp_path}/copy.zip"]
    both = registry_files.read_zipped(spark, paths, "Empresas")
    assert both.count() == 90_002
    rows = both.filter("file_name = 'Empresas0.zip'")
    row = rows.filter("cnpj_basico = '44999'").first()
    assert (row.razao_social, row.row_id, row.file_name) == ('a"b\nc', 44_999, "Empresas0.zip")
    assert rows.filter("cnpj_basico = 'x'").first().porte == ""


def test_empty_zip_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as archive:
        archive.writestr("pasta/", "")
    with pytest.raises(Exception, match="ZIP without files"):
        registry_files.read_zipped(spark, [f"{tmp_path}/e.zip"], "Empresas").count()


LISTING = "competence string, name string, size bigint, last_modified string"


def test_listing(spark):
    names = [("2026-07", n, 1, "d") for n in ("Empresas0.zip", "K3241.ESTABELECIMENTOS.ZIP", "x.zip", "Socios.csv")]
    got = rows_of(releases.known_files(spark.createDataFrame(names, LISTING)), "file_type")
    assert got == [("Empresas",), ("Estabelecimentos",)]
    found = spark.createDataFrame([("/public/2026-07/",), ("2025-12",), ("2026-13",)], "competence string")
    assert releases.latest_release(found).first().competence == "2026-07"
    with pytest.raises(Exception, match="no release month"):
        releases.latest_release(found.filter("competence = '2026-13'")).collect()


def test_files_to_load(spark):
    files = [("2026-07", f"Empresas{n}.zip", s, m) for n, s, m in (
        (0, 10, "a"), (1, 11, "a"), (2, None, None), (3, 10, "b"), (4, 10, "a"), (5, 10, "a"))]
    audit = [("2026-07", f"Empresas{n}.zip", st, 10, "a") for n, st in (
        (0, "success"), (1, "success"), (2, "success"), (3, "success"), (4, "failed"))]
    stored = spark.createDataFrame(
        audit, "competence string, file_name string, status string, source_size bigint, source_last_modified string")
    listing = spark.createDataFrame(files, LISTING)
    due = rows_of(releases.files_to_load(listing, stored), "name")
    assert due == [("Empresas1.zip",), ("Empresas3.zip",), ("Empresas4.zip",), ("Empresas5.zip",)]
    assert releases.files_to_load(listing, stored, force=True).count() == 6
    assert releases.files_to_load(listing, stored, kinds=("Socios",)).count() == 0


def test_population_files(spark, tmp_path):
    series = [{"resultados": [{"series": [
        {"localidade": {"id": "3550308"}, "serie": {"2024": "11.895.578", "2010": "1"}},
        {"localidade": {"id": "4106902"}, "serie": {"2024": "..."}},
        {"localidade": {"id": "1100015"}, "serie": {"2010": "5"}}]}]}]
    region = {"UF": {"sigla": "SP"}}
    cities = [
        {"id": 3550308, "nome": "São Paulo", "regiao-imediata": {"regiao-intermediaria": region}},
        {"id": 4106902, "nome": "Curitiba", "microrregiao": {"mesorregiao": {"UF": {"sigla": "PR"}}}},
        {"id": 1100015, "nome": "Alta", "regiao-imediata": {"regiao-intermediaria": region}},
    ]
    (tmp_path / "s.json").write_text(json.dumps(series))
    (tmp_path / "c.json").write_text(json.dumps(cities, ensure_ascii=False))
    counts = population.read_series(spark, str(tmp_path / "s.json"), 2024)
    catalogue = population.read_catalogue(spark, str(tmp_path / "c.json"))
    assert rows_of(catalogue, "uf", "codigo") == [("PR", "6902"), ("SP", "0015"), ("SP", "0308")]
    table = population.population_table(catalogue, counts, 2024)
    assert rows_of(table, "codigo_ibge", "populacao") == [("3550308", 11_895_578)]
    assert population.cities_without_population(catalogue, counts).count() == 2


def test_merge_is_idempotent(spark):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    updates = spark.createDataFrame([("2", "c", 1), ("2", "d", 2), ("3", "e", 1)], "id string, v string, n int")
    once = upsert.merge_latest(base, updates, "id", order=["n"])
    assert rows_of(once, "id", "v") == [("1", "a"), ("2", "d"), ("3", "e")]
    assert rows_of(upsert.merge_latest(once, updates, "id", order=["n"]), "id", "v") == rows_of(once, "id", "v")


def test_qualification_dates(spark):
    old, now = F.lit("2020-01-01").cast("timestamp"), F.lit("2026-01-01").cast("timestamp")
    history = spark.createDataFrame([("1",), ("2",), ("3",)], "cnpj string").withColumns(
        {"cnpj_basico": F.lit("old"), "qualification_status": F.lit("review_required"),
         "qualified_at": old, "last_qualified_at": old, "updated_at": old})
    new = spark.createDataFrame(
        [("1", "n", "qualified"), ("2", "n", "rejected"), ("4", "n", "rejected")],
        "cnpj string, cnpj_basico string, qualification_status string")
    merged = upsert.merge_qualification(history, new, now).withColumn("y", F.year("qualified_at"))
    assert rows_of(merged, "cnpj", "cnpj_basico", "qualification_status", "y") == [
        ("1", "old", "qualified", 2026), ("2", "old", "rejected", 2020),
        ("3", "old", "review_required", 2020), ("4", "n", "rejected", 2026)]
    again = upsert.merge_qualification(merged.drop("y"), new, now)
    assert again.count() == 4


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join_equals_plain_join(spark, how):
    many = spark.range(2_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    many = many.unionByName(spark.createDataFrame([(9_999, None)], "id long, k string"))
    one = spark.range(0, 2_000, 2).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    one = one.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))
    spread = skew.spread_join(many, one, "k", ["id"], how, hot_rows=100)
    plain = many.join(one, "k", how)
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.select(*spread.columns).collect()))
    hot = skew.hot_keys(skew.key_counts(many, "k"), "k", 100)
    assert [r._hot_key for r in hot.collect()] == ["hot"]
    salts = skew.add_salt(many, "k", hot, ["id"]).filter("k = 'hot'").select("_salt").distinct().count()
    assert salts == 7  # 667 rows in parts of 100


def test_hot_company_in_the_complete_view(spark):
    """The salted company view equals the unsalted one when one root owns most branches."""
    branch = ["cnpj_basico", "cnpj", *DATASETS["Estabelecimentos"].columns[3:]]
    rows = spark.range(500).select(
        F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).otherwise("7").alias("cnpj_basico"),
        F.col("id").cast("string").alias("cnpj"),
        *[F.lit("x").alias(c) for c in branch[2:]], F.lit("r").alias("source_competence"),
        F.lit(None).cast("timestamp").alias("updated_at"))
    roots = spark.range(300).select(F.col("id").cast("string").alias("cnpj_basico"))
    lookup = spark.createDataFrame([("x", "d")], "codigo string, descricao string")
    tables = {
        "estabelecimentos": rows, "cnaes": lookup, "municipios": lookup, "naturezas_juridicas": lookup,
        "empresas": roots.withColumns({c: F.lit("x") for c in (
            "razao_social", "natureza_juridica", "capital_social", "porte")}),
        "simples": roots.filter("cnpj_basico < 5").withColumns(
            {"opcao_simples": F.lit("S"), "opcao_mei": F.lit("N")}),
    }
    salted, plain = (views.complete_companies(tables, hot_rows=h) for h in (50, 10**9))
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))
    assert salted.count() == 460


def test_acceptance_report(spark):
    rows = spark.createDataFrame(
        [("a", "1", True), ("a", "1", True), ("a", "2", None), ("b", "3", False)],
        "file string, cnpj_basico string, ok boolean")
    got = rows_of(filters.acceptance_report(rows, F.col("ok"), "file"),
                  "file", "lidas", "gravadas", "ignoradas", "empresas_unicas")
    assert got == [("a", 3, 2, 1, 1), ("b", 1, 0, 1, 0)]


QUEUE = "cnpj string, has_state boolean, enrichment_version string, enrich_status string," \
    " next_retry_at timestamp, processing_run_id bigint, processing_started_at timestamp"


def test_pending(spark):
    import datetime as d

    early, late = d.datetime(2020, 1, 1), d.datetime(2030, 1, 1)
    rows = [
        ("new", None, None, None, None, None, None), ("old version", True, "v1", "done", None, None, None),
        ("done", True, "v2", "done", None, None, None), ("pending", True, "v2", "pending", None, None, None),
        ("due", True, "v2", "failed", early, None, None), ("later", True, "v2", "failed", late, None, None),
        ("no date", True, "v2", "no_site", None, None, None), ("busy", True, "v1", "done", None, 1, late),
        ("stuck", True, "v1", "done", None, 1, early), ("no version", True, None, "done", None, None, None),
    ]
    frame = spark.createDataFrame(rows, QUEUE)
    now = F.lit("2026-01-01").cast("timestamp")
    assert {r.cnpj for r in queue.pending(frame, now).collect()} == {
        "new", "old version", "pending", "due", "no date", "stuck", "no version"}
    assert queue.pending(frame, now, force=True).count() == len(rows)
    assert [r.cnpj for r in queue.keyset_batch(frame, 2, after="done").collect()] == ["due", "later"]


def test_next_retry(spark):
    schema = "retry_reason string, retry_after_days int, retry_after_hours int, enrich_status string"
    rows = [("google_places_no_result", 30, 1, "failed"), (None, 30, 1, "failed"), (None, None, 5, "failed"),
            (None, None, None, "no_site"), (None, None, None, "failed"), (None, None, None, "done"),
            (None, 0, 0, "done")]
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    got = [queue.next_retry(spark.createDataFrame([r], schema), now).select(
        ((F.unix_timestamp("next_retry_at") - F.unix_timestamp(now)) / 3600).cast("int")).first()[0] for r in rows]
    assert got == [2160, 720, 5, 720, 24, None, None]


def test_stream_loads_each_file_once(spark):
    incoming, log, checkpoint = (new_folder(spark, n) for n in ("in", "log", "ck"))

    def arrive(release, rows):
        frame = spark.createDataFrame([(k, v, "", "", "1", "", "") for k, v in rows], DATASETS["Empresas"].raw_schema)
        registry_files.write_delimited(frame, "Empresas", f"{incoming}/{release}")
        stream.start_ingest(spark, "Empresas", incoming, log, checkpoint, files_per_batch=2).awaitTermination()
        return rows_of(stream.current_table(spark, "Empresas", log), "cnpj_basico", "razao_social")

    assert arrive("2026-01", [("1", "a"), ("2", "b")]) == [("1", "a"), ("2", "b")]
    assert arrive("2026-02", [("2", "c"), ("3", "d")]) == [("1", "a"), ("2", "c"), ("3", "d")]
    assert arrive("2025-12", [("1", "older")]) == [("1", "a"), ("2", "c"), ("3", "d")]
    stream.start_ingest(spark, "Empresas", incoming, log, checkpoint).awaitTermination()
    assert spark.read.parquet(log).count() == 5


def test_load_dataset_follows_branches(spark):
    now = F.lit("2026-01-01").cast("timestamp")
    columns = DATASETS["Empresas"].columns
    raw = spark.createDataFrame(
        [("1", "a", "f1", 1), ("1", "b", "f2", 0), ("2", "c", "f1", 2), ("9", "z", "f1", 3)],
        "cnpj_basico string, razao_social string, file_name string, row_id int",
    ).withColumns({c: F.lit("") for c in columns[2:]}).withColumn("block_start", F.lit(0))
    branches = spark.createDataFrame([("1",), ("2",), ("2",)], "cnpj_basico string")
    loaded = ingest.load_dataset(
        "Empresas", raw, None, "2026-07", now, filters.BranchFilter(), branches=branches)
    assert rows_of(loaded.table, "cnpj_basico", "razao_social") == [("1", "b"), ("2", "c")]
    assert rows_of(loaded.report, "file_name", "rows_processed") == [("f1", 2), ("f2", 1)]
    again = ingest.load_dataset("Empresas", raw, loaded.table, "2026-08", now, None)
    assert rows_of(again.table, "cnpj_basico", "source_competence") == [
        ("1", "2026-08"), ("2", "2026-08"), ("9", "2026-08")]

"""Merges that keep what an update does not carry, order of the lead lists, pushed filters."""

import datetime

from pyspark.sql import functions as F

from fichario.operators import filters, leads, upsert

OUTREACH = (
    "razao_social nome_fantasia site_url site_final_url presence_score commerce_score fit_score pain_score"
    " presence_maturity commerce_maturity lead_classification contact_channel contact_value"
    " contact_confidence contact_role rejection_reasons qualification_reasons decisor_nome uf"
    " municipio_descricao plataforma whatsapp_url instagram_url last_qualified_at updated_at"
).split()


def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")


def test_enrichment_upsert_with_a_subset_of_columns(spark):
    state = spark.createDataFrame([("1", "vtex", 10), ("2", "vtex", 20)], "cnpj string, plataforma string, lead_score int")
    results = spark.createDataFrame([("2", 99), ("3", 5)], "cnpj string, lead_score int")
    once = upsert.merge_enrichment(state, results, now())
    twice = upsert.merge_enrichment(once, results, now())
    for merged in (once, twice):
        got = {r.cnpj: (r.plataforma, r.lead_score, r.enriched_at is not None) for r in merged.collect()}
        assert got == {"1": ("vtex", 10, False), "2": ("vtex", 99, True), "3": (None, 5, True)}


def test_qualification_upsert_keeps_columns_of_the_history(spark):
    history = spark.createDataFrame(
        [("1", "r1", "qualified", "note", None, None, None), ("2", "r2", "qualified", "note2", None, None, None)],
        "cnpj string, cnpj_basico string, qualification_status string, note string, qualified_at timestamp,"
        " last_qualified_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([("2", "x", "rejected"), ("3", "r3", "qualified")],
                                "cnpj string, cnpj_basico string, qualification_status string")
    got = {r.cnpj: (r.cnpj_basico, r.qualification_status, r.note, r.qualified_at) for r in
           upsert.merge_qualification(history, new, now()).collect()}
    then = datetime.datetime(2024, 5, 1)
    assert got == {"1": ("r1", "qualified", "note", None), "2": ("r2", "rejected", "note2", None), "3": ("r3", "qualified", None, then)}


def test_lead_lists_have_one_order(spark):
    rows = [("3", 5, None), ("1", None, None), ("2", 5, None), ("4", 9, None), ("0", None, None)]
    frame = spark.createDataFrame(rows, "cnpj string, digital_score int, qualified_at timestamp")
    assert [r.cnpj for r in leads.outreach_legacy(frame).collect()] == ["0", "1", "4", "2", "3"]
    wide = frame.withColumns({c: F.lit(None).cast("string") for c in OUTREACH})
    wide = wide.withColumns({"lead_score": F.col("digital_score"), "confidence_score": F.lit(1), "qualification_status": F.when(F.col("cnpj") != "4", "qualified")})
    assert [r.cnpj for r in leads.outreach(wide.withColumn("lead_score", F.lit(1))).collect()] == ["0", "1", "2", "3", "4"]
    assert [r.cnpj for r in leads.qualified_list(wide).collect()] == ["2", "3", "0", "1"]


def test_active_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("02", 1), ("08", 2), (None, 3)], "situacao_cadastral string, n int").write.parquet(f"{tmp_path}/b")
    kept = spark.read.parquet(f"{tmp_path}/b").filter(filters.is_active())
    assert [r.n for r in kept.collect()] == [1]
    assert "EqualTo(situacao_cadastral,02)" in kept._jdf.queryExecution().executedPlan().toString()

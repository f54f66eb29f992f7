"""Places of one enrichment feed the next: kept while fresh, searched again afterwards."""

from pyspark.sql import functions as F

from fichario.operators import queue
from fichario.plans import enrich


def at(text):
    return F.lit(text).cast("timestamp")


def test_fresh_places_are_kept_with_their_details(spark):
    companies = spark.createDataFrame(
        [(c, "Padaria Sol", "Padaria Sol Ltda", "Curitiba", "PR", "1133334444", "Rua A", "80000-000", f"a@x{c}.com", "12345678")
         for c in ("1", "2")],
        "cnpj string, nome_fantasia string, razao_social string, municipio_descricao string, uf string,"
        " telefone_1 string, logradouro string, cep string, email string, cnpj_basico string")
    rows = companies.withColumns({
        "site_url": F.lit(None).cast("string"), "site_source": F.lit(None).cast("string"),
        "google_place_match_score": F.lit(0), "google_business_status": F.lit(None).cast("string"),
        "retry_reason": F.lit(None).cast("string")})
    places = spark.createDataFrame(
        [("1", 0, "p1", "Padaria Sol", "Rua A, Curitiba - PR , 80000000", "1133334444", "https://sol.com.br", "OPERATIONAL", 4.5)],
        "cnpj string, position int, place_id string, display_name string, formatted_address string,"
        " national_phone string, website string, business_status string, rating double")
    first = enrich._overlay_places(rows, places, 1000, None, at("2024-01-01 00:00:00"))
    got = {r.cnpj: r for r in first.collect()}
    one = got["1"]
    assert (one.google_place_id, one.google_place_name, one.google_rating, one.site_source) == ("p1", "Padaria Sol", 4.5, "google_places")
    assert str(one.google_places_checked_at) == "2024-01-01 00:00:00" and one.retry_reason is None
    assert got["2"].retry_reason == "google_places_no_result" and got["2"].google_place_id is None
    state = spark.createDataFrame(first.collect(), first.schema)
    assert [r.cnpj for r in state.filter(queue.place_is_cached(at("2024-02-01 00:00:00"))).collect()] == ["1"]
    moved = places.withColumn("place_id", F.lit("p9"))
    for now, place, checked in (("2024-02-01", "p1", "2024-01-01"), ("2024-06-01", "p9", "2024-06-01")):
        again = {r.cnpj: r for r in enrich._overlay_places(rows, moved, 1000, state, at(f"{now} 00:00:00")).collect()}
        assert again["1"].google_place_id == place and again["1"].google_rating == 4.5
        assert str(again["1"].google_places_checked_at) == f"{checked} 00:00:00"
        assert again["1"].site_url == "https://sol.com.br" and again["1"].retry_reason is None

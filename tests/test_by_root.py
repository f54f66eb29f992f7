"""Tables stored by root: the same rows as the salted joins, without a shuffle, hot roots beside."""

import pytest
from pyspark.sql import functions as F

from fichario.catalog.inputs import Inputs
from fichario.operators import by_root, filters, skew, views
from fichario.session import new_folder

FOLDER = "/root/testdata/sf0.001"
TABLES = ("estabelecimentos", "empresas", "simples", "socios")


@pytest.fixture(params=[skew.HOT_ROWS, 25])
def roots(request, spark):
    """Roots with 25 branches or partners and more are hot in the second run."""
    t = Inputs(spark, FOLDER).registry
    hot = by_root.hot_roots([t["estabelecimentos"], t["socios"]], request.param)
    assert bool(hot) == (request.param == 25)
    return t, {name: by_root.store(t[name], new_folder(spark, f"test-{name}"), 8, hot) for name in TABLES}


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


def test_same_rows_without_a_shuffle(spark, roots):
    t, stored = roots
    for name in TABLES:
        assert rows_of(stored[name].all()) == rows_of(t[name])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        companies = stored["empresas"].map(lambda rows: rows.select("cnpj_basico", "razao_social"))
        joined = by_root.join(stored["estabelecimentos"], companies).all()
        partners = filters.follow_stored(
            stored["socios"], stored["estabelecimentos"].map(lambda rows: rows.filter("situacao_cadastral = '02'")))
        for frame in (joined, partners):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning(cnpj_basico" not in plan or stored["socios"].hot is not None
            if stored["socios"].hot is None:
                assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows_of(views.stored_companies(stored, t)) == rows_of(views.complete_companies(t))
    accepted = t["estabelecimentos"].filter("situacao_cadastral = '02'")
    assert rows_of(partners) == rows_of(filters.follow_branches(t["socios"], accepted, ["id"]).select(partners.columns))


def test_odd_keys(spark):
    rows = spark.createDataFrame([(None, 1), ("", 2), ("a", 3), ("a", 4), ("b", 5)], "cnpj_basico string, n int")
    one = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "cnpj_basico string, t string")
    hot = by_root.hot_roots([rows], 2)
    assert hot == ["a"]
    many, single = (by_root.store(r, new_folder(spark, "odd"), 4, hot) for r in (rows, one))
    assert sorted(r.n for r in many.hot.collect()) == [3, 4]
    got = by_root.join(many, single, "left").all().select("n", F.coalesce("t", F.lit("-")).alias("t"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "-"), (2, "-"), (3, "x"), (4, "x"), (5, "y")]
    empty = by_root.store(rows.limit(0), new_folder(spark, "odd"), 4, [])
    assert empty.all().count() == 0 and by_root.hot_roots([rows.limit(0)], 2) == []

"""Merges that tell what changed, and counts kept by it."""

import random

from pyspark.sql import functions as F

from fichario.operators import changes, reports

SCHEMA = "k string, a string, b int, updated_at timestamp"


def time(month):
    return F.lit(f"2024-0{month}-01 00:00:00").cast("timestamp")


def table(spark, rows):
    frame = spark.createDataFrame([(*r, None) for r in rows], SCHEMA).withColumn("updated_at", time(1))
    return changes.hashed(frame, "k")


def happened(rows):
    return {r.k: r.change for r in rows.collect()}


def test_a_repeated_merge_changes_nothing(spark):
    base = table(spark, [("1", "x", 1), ("2", None, 2), ("3", "", 3), ("4", "x", None)])
    updates = spark.createDataFrame(
        [("1", "x", 1, 1), ("2", "", 1, 2), ("3", "y", 1, 1), ("3", "z", 2, 1), ("5", None, 1, 9), (None, "q", 1, 1)],
        "k string, a string, place int, extra int")
    found = changes.merge_changes(base, updates.drop("extra"), "k", time(2), ["place"])
    assert happened(found) == {"1": "unchanged", "2": "updated", "3": "updated", "5": "inserted"}
    after = changes.apply_changes(base, found, "k")
    got = {r.k: (r.a, r.b, r.updated_at.month) for r in after.collect()}
    assert got == {"1": ("x", 1, 1), "2": ("", 2, 2), "3": ("z", 3, 2), "4": ("x", None, 1), "5": (None, None, 2)}
    again = changes.merge_changes(after, updates, "k", time(3), ["place"])
    assert set(happened(again).values()) == {"unchanged"}
    assert sorted(map(repr, changes.apply_changes(after, again, "k").collect())) == sorted(map(repr, after.collect()))
    none = changes.merge_changes(base, updates.limit(0), "k", time(2))
    assert none.count() == 0 and changes.apply_changes(base, none, "k").count() == 4


def test_counts_follow_three_merges(spark):
    random.seed(4)
    values = ["x", "y", "z", None]
    base = table(spark, [(str(n), random.choice(values), n % 3) for n in range(60)])
    counted = reports.counts_by(base, "a", keep_null=True)
    both = base.groupBy("a", "b").agg(F.count(F.lit(1)).alias("total"))
    for turn in range(3):
        rows = [(str(random.randrange(90)), random.choice([*values, f"new{turn}"]), turn) for _ in range(40)]
        updates = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "k string, a string, b int, place int")
        found = changes.merge_changes(base, updates, "k", time(2), ["place"])
        counted = changes.apply_deltas(counted, changes.count_deltas(found, "a"), "a")
        both = changes.apply_deltas(both, changes.count_deltas(found, "a", "b"), "a", "b")
        base = spark.createDataFrame(changes.apply_changes(base, found, "k").collect(), base.schema)
        recount = reports.counts_by(base, "a", keep_null=True)
        assert sorted(map(repr, counted.collect())) == sorted(map(repr, recount.collect()))
    recount = base.groupBy("a", "b").agg(F.count(F.lit(1)).alias("total"))
    assert sorted(map(repr, both.collect())) == sorted(map(repr, recount.collect()))


def test_sections_in_one_scan(spark):
    rows = spark.createDataFrame([("x", 1), ("x", None), (None, 2)], "p string, q int")
    found = {(r.secao, r.valor): r.total for r in reports.section_counts(rows, "p", "q").collect()}
    assert found == {("p", "x"): 2, ("q", "1"): 1, ("q", "2"): 1}

"""Virtual slots: near equal bytes, gapless places, stable edits of the map."""

import zlib

from pyspark.sql import functions as F

from fichario.llm import slots
from fichario.llm.catalog import op7_sharding


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for found in by.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
    loads = [sum(r.size for r in by.get(s, [])) for s in range(shards)]
    return loads


def test_whole_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op7_sharding(spark, folder).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    loads = check(rows, 16)
    assert max(loads) - min(loads) <= max(map(len, texts.values())) and max(loads) < 1.02 * sum(loads) / 16


def test_odd_rows(spark):
    rows = [(None, "a", 1), (None, "b", 1), (3, None, 1), (4, "", 1), (4, "", 1), (5, "é" * 40_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    found = slots.assign(docs, 4).collect()
    assert sorted(r.size for r in found) == [1, 1, 1, 2, 2, 80_001]
    check(found, 4)
    assert slots.assign(docs.limit(0)).count() == 0


def test_a_map_is_edited_not_made_anew():
    loads = [(v, 100 + v % 7, 1) for v in range(4096)]
    total = sum(b for _, b, _ in loads)
    first = slots.first_map(loads, 16)
    assert slots.rebalanced(first, loads, 16) == first
    grown = slots.rebalanced(first, loads, 17)
    moved = [v for v in first if first[v] != grown[v]]
    assert {grown[v] for v in moved} == {16}
    assert abs(sum(loads[v][1] for v in moved) - total / 17) < 0.05 * total / 17
    shrunk = slots.rebalanced(grown, loads, 16)
    assert {v for v in grown if grown[v] != shrunk[v]} >= {v for v in grown if grown[v] == 16}
    sums = [sum(loads[v][1] for v in shrunk if shrunk[v] == s) for s in range(16)]
    assert max(sums) < 1.02 * total / 16
    hot = [(0, 50 * total, 1), *loads[1:]]
    assert set(slots.rebalanced(first, hot, 16).values()) == set(range(16))


def test_versions_and_files(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    rows = slots.records(docs, 64)
    loads = slots.weights(rows)
    one = slots.store_map(spark, slots.first_map(loads, 4, 64), 1)
    two = slots.store_map(spark, slots.rebalanced(slots.load_map(one), loads, 5), 2)
    both = one.unionByName(two)
    assert slots.load_map(both) == slots.load_map(two) != slots.load_map(one)
    path = slots.write_shards(docs, both, 64)
    back = spark.read.parquet(path)
    assert back.count() == 500
    want = {r.doc_id: r.shard for r in slots.placed(rows, both).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want
    assert slots.placed(rows, both).select("shard").distinct().count() == 5


def test_law_holds_for_repeated_ids_and_rows(spark, monkeypatch):
    monkeypatch.setattr(slots, "PIECE_ROWS", 3)
    several = [(7, f"{'long ' * (n % 40)}{n}") for n in range(2000)] + [(n, f"{'text ' * (n % 40)}{n}") for n in range(10, 2010)]
    equal = [(7, "x" * 50)] * 2000 + [(None, None)] * 1000 + [(n, f"some text {n} " * 3) for n in range(10, 1010)]
    for rows in (several, equal):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        found = slots.assign(docs, 16).collect()
        assert sorted((r.doc_id or -1, r.text_crc32) for r in found) == sorted(
            (i or -1, zlib.crc32((t or "").encode())) for i, t in rows)
        loads = check(found, 16)
        assert max(loads) < 1.02 * sum(loads) / 16 and min(loads) > 0.98 * sum(loads) / 16
        path = slots.write_shards(docs, slots.store_map(spark, slots.first_map([], 16), 1))
        parts = {r.shard: r.n for r in spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("n")).collect()}
        assert sum(parts.values()) == len(rows) and max(parts.values()) < 1.3 * len(rows) / 16

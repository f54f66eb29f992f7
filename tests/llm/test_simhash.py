"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fichario.llm import simhash
from fichario.llm.catalog import op10_simhash
from fichario.llm.common import connected_components


def slow_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Smallest id by repeated minimum over all pairs; fps: id -> fingerprint."""
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if bin(fps[i] ^ fps[j]).count("1") <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_whole_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10_simhash(spark, folder).collect()
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == slow_components(fps)
    assert len({r.component_id for r in rows}) < len(rows)


@pytest.mark.parametrize("text", [None, "", " \t\n\x0b\x0c\r", "one", "One TWO", "É È ÉÈ É", "a\x00b c d", "x\x85y z\xa0 w q"])
def test_fingerprint_of_odd_texts(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(5, "a b c d", 1), (5, "a b c d", 2), (None, "a b c d", 3), (7, None, 4), (6, "", 5),
            (None, "q w e r t", 6), (9, "x " * 50_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    found = sorted((r.component_id is None, r.component_id or 0) for r in simhash.near_duplicates(docs).collect())
    assert found == [(False, 5)] * 3 + [(False, 6)] * 2 + [(False, 9), (True, 0)]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "6", "9", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [4096, 8, 1])
def test_links_lose_nothing_when_buckets_are_dealt_again(spark, most):
    random.seed(3)
    centre = random.getrandbits(64)
    fps = {random.getrandbits(64) for _ in range(50)}
    for _ in range(400):
        x = centre
        for bit in random.sample(range(10), random.randrange(6)):
            x ^= 1 << bit * 6
        fps.add(x)
    chain = random.getrandbits(64)
    for bit in range(0, 60, 3):
        chain ^= 7 << bit
        fps.add(chain)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(frame, most).collect()
    for r in found:
        assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 3
    want = slow_components({f: f % (1 << 64) for f in signed})
    roots = {r.id: r.root for r in connected_components(simhash.links(frame, most)).collect()}
    by_root, by_want = {}, {}
    for f in signed:
        by_root.setdefault(roots.get(f, f), set()).add(f)
        by_want.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 3000).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    roots = connected_components(chain.unionByName(star)).collect()
    assert len(roots) == 301 + 2001
    assert len({r.root for r in roots if r.id <= 300}) == 1
    assert len({r.root for r in roots}) == 2

"""Certified cutoffs: exact bounds, the promise on fresh data, SQL, odd rows."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fichario.llm import quality_rules as q
from fichario.llm.catalog import op2_quality_rules


def exact_tail(n, k, p):
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                              + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(min(k, n) + 1))


def test_binomial_tail(spark):
    cases = [(n, k) for n in (1, 5, 40, 1000, 50_000) for k in (0, 1, 3, 10, 150, 199) if k < n * 0.004]
    frame = spark.createDataFrame(cases, "n long, k long")
    for r in frame.select("n", "k", q.binomial_tail(F.col("n"), F.col("k"), 0.004).alias("p")).collect():
        assert r.p == pytest.approx(exact_tail(r.n, r.k, 0.004), rel=1e-7)


def slow_base(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for found in places.values() if len(found) > 1 for i in found for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_whole_query_against_brute_force_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op2_quality_rules(spark, folder)
    rows = found.collect()
    for r in rows:
        base = slow_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r.kept and r.base_failed)
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, db.execute(q.SQL).fetchall()))


def test_repeats_of_odd_texts(spark):
    random.seed(1)
    texts = ["", None, "a " * 7, "a " * 8, "a " * 9, "a b " * 30, "x\x0by\x0cz\x85w " * 9, "\n \n", "q\n" * 12]
    texts += [" ".join(random.choices("ab", k=random.randrange(60))) for _ in range(200)]
    docs = spark.createDataFrame([(n, t, "en", 1) for n, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    for r in q.measured(docs, "lang").select("__row.doc_id", *q.BASE).collect():
        assert tuple(r)[1:] == slow_base(texts[r.doc_id]), texts[r.doc_id]


def holdout(spark, n_good, false_rate, n_poor=500, stratum="en"):
    random.seed(n_good)
    rows = [(stratum, *([0] * 4), random.randrange(600, 900) if random.random() < false_rate else random.randrange(90), True)
            for _ in range(n_good)]
    rows += [(stratum, *([0] * 4), random.randrange(200, 1000), False) for _ in range(n_poor)]
    return rows


def test_promise_holds_and_small_strata_lose_nothing(spark):
    ddl = "stratum string, " + ", ".join(f"{r} int" for r in q.RULES) + ", good boolean"
    rows = holdout(spark, 20_000, 0.0005) + holdout(spark, 40, 0.0, stratum="few") + holdout(spark, 20_000, 0.3, stratum="bad")
    limits = {r.stratum: r.asDict() for r in q.cutoffs(spark.createDataFrame(rows, ddl)).collect()}
    assert 89 <= limits["en"]["max_capitals"] < 300 and limits["en"]["max_marks"] is None
    assert "few" not in limits  # forty labels prove nothing
    bad = limits.get("bad", {}).get("max_capitals")
    good = [r[5] for r in rows if r[0] == "bad" and r[6]]
    assert bad is None or sum(v > bad for v in good) <= q.ALPHA / len(q.RULES) * len(good)


def test_odd_rows(spark):
    text = " ".join(f"word{n}" for n in range(40))
    rows = [(1, text, "en", True), (1, text, "en", True), (None, text, None, True), (2, None, "en", True), (3, "", None, True),
            (4, "z " * 60_000, "en", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept boolean")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (99, 1)], "doc_id long, quality int")
    kept = sorted((str(r.doc_id), r.kept, r.base_failed) for r in q.judge(docs, labels).collect())
    assert kept == [("1", True, False)] * 2 + [("2", False, True), ("3", False, True), ("4", False, True), ("None", True, False)]
    good = q.keep_good(docs, labels)
    assert good.columns == docs.columns and sorted(str(r.doc_id) for r in good.collect()) == ["1", "1", "None"]
    assert q.judge(docs.limit(0), labels).count() == 0 and q.judge(docs, labels.limit(0)).count() == len(rows)

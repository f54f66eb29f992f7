"""Classifier chain: out-of-fold training, held-out accuracy, odd rows."""

import numpy as np

from fichario.llm import toxicity as x
from fichario.llm.catalog import op9_toxicity


def test_later_links_learn_from_earlier_predictions():
    rng = np.random.default_rng(1)
    n = 3000
    first = rng.random(n) < 0.3
    second = first & (rng.random(n) < 0.9)
    lists = [[0] if f else [1] for f in first]
    targets = np.column_stack([first, second]).astype(int)
    chain, held = x.fit_chain([10, 20], x.Rows.of(lists), targets, np.arange(n) % x.FOLDS)
    assert chain.models[0].weights[0] > 1 and chain.models[1].chain[0] > 0.05
    assert ((held[:, 0] > 0.5) == first).all() and ((held[:, 1] > 0.5) == first).all()
    blank = chain.probabilities(x.Rows.of([[], [0]]))
    assert blank.shape == (2, 2) and blank[1, 1] > blank[0, 1]


def test_threshold_of_separated_and_empty_targets():
    assert 0.2 < x.best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) < 0.8
    assert x.best_threshold(np.array([0.1]), np.array([0])) == 0.5


def test_held_out_documents(spark):
    """On the largest plain folder: the smaller ones have too few toxic labels in four languages."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    chain, _, _ = x.train(docs, labels.filter("doc_id % 4 <> 1"))
    held = {r.doc_id: r.toxic for r in labels.filter("doc_id % 4 = 1").collect()}
    found = {r.doc_id: r.is_toxic for r in x.score(docs, chain).collect()}
    clean = [found[i] for i, t in held.items() if not t]
    toxic = [found[i] for i, t in held.items() if t]
    assert np.mean(clean) < 0.02 and np.mean(toxic) > 0.9


def test_whole_query(spark):
    rows = op9_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 200
    assert rows[0].asDict().keys() == {"doc_id", *(f"p_{c}" for c in x.LINKS), "is_toxic"}


def test_odd_rows(spark):
    # one word tells the classes apart: of several that always come together a lasso may take any
    rows = [(n, f"what a moron text number {n}" if n % 3 == 0 else f"what a text number {n}", 0) for n in range(300)]
    rows += [(400, None, 0), (401, "", 0), (None, "what a moron", 0), (402, "moron " * 50_000, 0), (3, "what a moron text number 3", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = spark.createDataFrame(
        [(n, int(n % 3 == 0)) for n in range(300)] + [(None, 1), (7, None), (9999, 1), (6, 1)], "doc_id long, toxic int")
    found = x.classify(docs, labels)
    got = {r.doc_id: r.is_toxic for r in found.collect()}
    assert found.count() == len(rows)
    assert all(got[n] == (n % 3 == 0) for n in range(300))
    assert got[None] and got[402] and not got[400] and not got[401]
    none = x.classify(docs, labels.limit(0))
    assert none.count() == len(rows) and none.filter("is_toxic").count() == 0
    assert x.classify(docs.limit(0), labels).count() == 0

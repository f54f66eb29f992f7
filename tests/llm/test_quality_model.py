"""Weak labels and the scorer: EM on known accuracies, held-out labels, odd rows."""

import numpy as np
import pytest

from fichario.llm import quality_model as q
from fichario.llm.catalog import op1_quality_classifier


def test_em_recovers_the_accuracies_of_labellers():
    rng = np.random.default_rng(7)
    accuracy, n = np.array([0.95, 0.9, 0.8, 0.7, 0.6]), 20_000
    truth = np.where(rng.random(n) < 0.8, 1, -1)
    votes = np.where(rng.random((n, 5)) < accuracy, truth[:, None], -truth[:, None])
    votes[rng.random((n, 5)) < 0.2] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, says = q.posteriors(patterns, counts.astype(float), 500)
    assert np.abs(says[:, 1] - accuracy).max() < 0.05 and np.abs(1 - says[:, 0] - accuracy).max() < 0.08
    assert ((good[inverse.ravel()] > 0.5) == (truth > 0)).mean() > 0.95


def test_held_out_labels_and_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op1_quality_classifier(spark, folder).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 1000
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    poor = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.1  # labels were never shown


def test_odd_rows(spark):
    text = "Plain words of a text that goes on. It has sentences and nothing odd. " * 6
    rows = [(n, f"{text} {n}", 0.5) for n in range(30)]
    rows += [(100 + n, f"THESE!! ARE$$$ ALL### MARKS%%% {n} " * 20, 0.5) for n in range(10)]
    rows += [(200, None, 0.5), (201, "", 0.5), (None, text, 0.5), (5, f"{text} 5", 0.5), (202, "word " * 60_000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = q.classify(docs)
    assert found.columns == ["doc_id", "weak_good", "score", "kept"]
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert found.count() == len(rows)
    assert kept[None] and all(kept[n] for n in range(30)) and not any(kept[100 + n] for n in range(10))
    assert not kept[200] and not kept[201]
    assert q.classify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_names_hold_whatever_the_mix(share):
    """Labellers that see seven of ten poor texts, and one that always says poor."""
    rng = np.random.default_rng(int(share * 10))
    n = 20_000
    kind = rng.random(n) < share
    votes = np.where(rng.random((n, 5)) < np.where(kind, 0.3, 0.99)[:, None], 1, -1)
    votes[:, 4] = -1
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, says = q.posteriors(patterns, counts.astype(float), least=q.LEAST_GOOD)
    named = good[inverse.ravel()] > 0.5
    assert named[~kind].mean() > 0.9 and named[kind].mean() < 0.1
    assert (says[:, 0] <= says[:, 1]).all()


def test_votes_that_tell_nothing():
    patterns, counts = np.array([[1, 1], [-1, -1], [0, 0]]), np.array([0.0, 5.0, 2.0])
    good, _ = q.posteriors(patterns, counts)
    assert good[0] > 0.5 > good[1] and abs(good[2] - 0.5) < 1e-9


@pytest.mark.parametrize("of", [0.1, 0.5, 0.9])
def test_given_texts_of_another_mix(spark, of):
    """Documents of the given table such that the share `of` is poor by their labels, which stay unseen."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    poor, good = (labels.filter(f"quality = {k}").orderBy("doc_id") for k in (0, 1))
    n = 500
    chosen = poor.limit(int(n * of)).unionByName(good.limit(n - int(n * of)))
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(chosen, "doc_id")
    rows = q.classify(docs.drop("quality")).join(chosen, "doc_id").collect()
    assert np.mean([r.kept for r in rows if r.quality]) > 0.9
    assert np.mean([r.kept for r in rows if not r.quality]) < 0.1

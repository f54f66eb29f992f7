"""Toxicity by a classifier chain: linear models in sequence, each fed with the earlier ones.

Links: three categories, then toxicity itself. A link is a logistic model on hashed words and on the
log-odds that the links before it gave. In training these are out-of-fold predictions (the model that
made them had not seen the document), so later links do not learn to trust memory; in scoring they
come from models fitted on all folds. The decision threshold is the one with the best F1 on the
out-of-fold predictions of the last link.

Features: words and the beginnings of longer words are hashed into 2^20 buckets; the buckets whose share of toxic documents differs from
the others' beyond chance are used. Features and models are fitted on a bounded sample of the
labelled rows (TRAIN_ROWS); the scoring covers everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import saved, text_key

BUCKETS = 1 << 20
MIN_Z = 6.0  # about one chance in a thousand that any of 2^20 buckets gets there
MAX_FEATURES = 4_096  # the strongest buckets: the size of the model
TRAIN_ROWS = 20_000  # labels that the chain is fitted on
FOLDS = 3
LASSO = 3e-4
PREFIXES = (4, 5)  # letters: inflected and made-up forms share a stem

# Words that tell which kind of toxicity a toxic document shows.
CATEGORIES = {
    "insult": ("clown", "dumb", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "hate", "pathetic", "ridiculous", "useless", "vile", "worthless"),
    "degradation": ("animal", "filth", "garbage", "pig", "rat", "scum", "trash", "vermin"),
}
LINKS = (*CATEGORIES, "toxic")


def plain_words(text: str = "text") -> Column:
    return F.array_distinct(F.array_remove(
        F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), ""))


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def buckets(found: Column) -> Column:
    """Distinct buckets of a text's words and of the beginnings of its longer words. The words should
    be a column of their own, so that a text is split once."""
    long = F.filter(found, lambda w: F.length(w) > max(PREFIXES))

    def begun(n: int) -> Column:
        return F.transform(long, lambda w: bucket(F.concat(F.lit("^"), F.left(w, F.lit(n)))))

    return F.array_distinct(F.concat(F.transform(found, bucket), *map(begun, PREFIXES)))


def one_label(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: documents with any toxic label are toxic; null ids and labels go."""
    return labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))


def selected(labelled: DataFrame, n_toxic: int, n_clean: int) -> list[int]:
    """Buckets that tell toxic from clean, strongest first, from labelled (toxic, buckets)."""
    counts = labelled.select("toxic", F.explode("buckets").alias("b")).groupBy("b").agg(
        F.sum("toxic").alias("t"), F.count("*").alias("n"))
    pooled = (F.col("n") + 1) / (n_toxic + n_clean + 2)
    gap = (F.col("t") + 0.5) / (n_toxic + 1) - (F.col("n") - F.col("t") + 0.5) / (n_clean + 1)
    z = F.abs(gap) / F.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_clean))
    strong = counts.select("b", z.alias("z")).filter(F.col("z") >= MIN_Z)
    return [r.b for r in strong.orderBy(F.desc("z"), "b").limit(MAX_FEATURES).collect()]


@dataclass
class Rows:
    """Sparse rows: feature numbers one after another, and the row that each belongs to."""

    at: np.ndarray
    row: np.ndarray
    n: int

    @classmethod
    def of(cls, lists) -> "Rows":
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64)
        return cls(flat.astype(np.int64), np.repeat(np.arange(len(lists)), sizes), len(lists))

    def take(self, mask: np.ndarray) -> "Rows":
        new = np.cumsum(mask) - 1
        use = mask[self.row]
        return Rows(self.at[use], new[self.row[use]], int(mask.sum()))


@dataclass
class Model:
    """weights of the buckets, of the earlier links' log-odds, and the intercept."""

    weights: np.ndarray
    chain: np.ndarray
    base: float

    def log_odds(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        plain = np.bincount(rows.row, self.weights[rows.at], rows.n) if rows.n else np.zeros(0)
        return np.clip(plain + earlier @ self.chain + self.base, -30, 30)


def fit(rows: Rows, earlier: np.ndarray, target: np.ndarray, size: int, lasso: float = LASSO, rounds: int = 60) -> Model:
    """Logistic regression with a lasso, by coordinate steps under the curvature's bound: words that
    merely keep company with the telling ones, as in copies of one text, get no weight. A target
    without both classes gives a constant."""
    n, links = max(1, rows.n), earlier.shape[1]
    rate = (target.sum() + 0.5) / (n + 1)
    base, weights, chain = float(np.log(rate / (1 - rate))), np.zeros(size), np.zeros(links)
    if not rows.n or target.min() == target.max():
        return Model(weights, chain, base)
    order = np.argsort(rows.at, kind="stable")
    where = np.split(rows.row[order], np.cumsum(np.bincount(rows.at, minlength=size))[:-1])
    odds = np.full(n, base)

    def error(at=slice(None)) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(odds[at], -30, 30))) - target[at]

    active = np.arange(size)
    for turn in range(rounds):
        moved = 0.0
        for j in np.arange(size) if turn % 10 == 0 else active:
            at = where[j]
            if not len(at):
                continue
            step = 4 * n / len(at)
            new = weights[j] - step * error(at).sum() / n
            new = np.sign(new) * max(abs(new) - step * lasso, 0.0)
            if new != weights[j]:
                odds[at] += new - weights[j]
                moved = max(moved, abs(new - weights[j]))
                weights[j] = new
        active = np.flatnonzero(weights)
        for j in range(links):
            x = earlier[:, j]
            new = chain[j] - 4 * (error() @ x) / max(x @ x, 1e-9)
            odds += (new - chain[j]) * x
            chain[j] = new
        for _ in range(3):
            change = -4 * error().mean()
            base, odds = base + change, odds + change
        if moved < 1e-3 and turn % 10 == 0:
            break
    return Model(weights, chain, base)


@dataclass
class Chain:
    features: list[int]
    models: list[Model]
    threshold: float

    def probabilities(self, rows: Rows) -> np.ndarray:
        """One column per link."""
        odds = np.zeros((rows.n, 0))
        for model in self.models:
            odds = np.column_stack([odds, model.log_odds(rows, odds)])
        return 1 / (1 + np.exp(-odds))


def best_threshold(probability: np.ndarray, target: np.ndarray) -> float:
    """The middle of the gap at which F1 is best; 0.5 without positives."""
    if not target.sum():
        return 0.5
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum(target[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + target.sum())
    sorted_ = probability[order]
    last = np.append(sorted_[1:] < sorted_[:-1], True)  # equal values go together
    best = int(np.argmax(np.where(last, f1, -1)))
    below = sorted_[best + 1] if best + 1 < len(sorted_) else 0.0
    return float((sorted_[best] + below) / 2)


def fit_chain(features: list[int], rows: Rows, targets: np.ndarray, folds: np.ndarray) -> tuple[Chain, np.ndarray]:
    """The chain, and the out-of-fold probabilities of its links."""
    odds, models = np.zeros((rows.n, 0)), []
    for link in range(targets.shape[1]):
        target = targets[:, link].astype(float)
        held = np.zeros(rows.n)
        for fold in range(FOLDS):
            out = folds == fold
            model = fit(rows.take(~out), odds[~out], target[~out], len(features))
            held[out] = model.log_odds(rows.take(out), odds[out])
        models.append(fit(rows, odds, target, len(features)))
        odds = np.column_stack([odds, held])
    probabilities = 1 / (1 + np.exp(-odds))
    threshold = best_threshold(probabilities[:, -1], targets[:, -1]) if rows.n else 0.5
    return Chain(features, models, threshold), probabilities


def _numbered(features: list[int]) -> Column:
    """Buckets of a text that are features; the list of features is bounded."""
    wanted = F.array(*[F.lit(b) for b in features]) if features else F.array().cast("array<int>")
    return F.array_intersect(F.col("buckets"), wanted)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Chain, np.ndarray, np.ndarray]:
    """The chain; out-of-fold probabilities and targets of the sample it was fitted on.

    The sample is drawn from the labels by a hash: about `rows` of them, few enough to be sent to the
    texts, which therefore stay where they are. Labels without a document, and documents without a
    label, do not count; of documents that share an id the one with the smallest text hash does.
    """
    known = one_label(labels)
    share = min(1.0, rows / max(1, known.count()))
    key = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(FOLDS * (1 << 28)))
    picked = saved(
        known.withColumn("key", key).filter(F.floor(F.col("key") / FOLDS) < int(share * (1 << 28)))
        .select("doc_id", "toxic", F.pmod("key", F.lit(FOLDS)).cast("int").alias("fold")), "toxic-sample")
    hits = [F.arrays_overlap("words", F.array(*map(F.lit, lexicon))).cast("int").alias(c)
            for c, lexicon in CATEGORIES.items()]
    fields = ["toxic", "fold", *CATEGORIES, "buckets"]
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "doc_id", "toxic", "fold", text_key().alias("k"), plain_words().alias("words"))
    found = texts.select(
        "doc_id", "k", "toxic", "fold", *hits, buckets(F.col("words")).alias("buckets"))
    labelled = saved(
        found.groupBy("doc_id").agg(F.min(F.struct("k", *fields)).alias("x")).select("x.*"), "toxic-labelled")
    totals = labelled.agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = totals.t, totals.n - totals.t
    features = selected(labelled, n_toxic, n_clean) if n_toxic and n_clean else []
    sample = labelled.select(
        "fold", "toxic", *CATEGORIES, _numbered(features).alias("buckets")).toPandas()
    place = {b: n for n, b in enumerate(features)}
    lists = [[place[b] for b in x] for x in sample["buckets"]]
    toxic = sample["toxic"].to_numpy(np.int64).reshape(-1, 1)
    targets = np.column_stack([sample[list(CATEGORIES)].to_numpy(np.int64) * toxic, toxic])
    chain, held = fit_chain(features, Rows.of(lists), targets, sample["fold"].to_numpy())
    return chain, held, targets


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<link> for every link, is_toxic of every row of docs. A map over rows: words are
    hashed where the text lies, the few buckets of the model go to a vectorised scorer."""
    place = {b: n for n, b in enumerate(chain.features)}
    names = [f"p_{link}" for link in LINKS]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = Rows.of([[place[b] for b in x] for x in batch])
            yield pd.DataFrame(chain.probabilities(rows), columns=names)

    scorer = F.pandas_udf(run, ", ".join(f"{c} double" for c in names))
    split = docs.select("doc_id", plain_words().alias("words"))
    hashed = split.select("doc_id", buckets(F.col("words")).alias("buckets"))
    found = hashed.select("doc_id", _numbered(chain.features).alias("b"))
    return found.select("doc_id", scorer("b").alias("p")).select("doc_id", "p.*").withColumn(
        "is_toxic", F.col("p_toxic") >= chain.threshold)


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Probabilities of every link and is_toxic for every row of docs, by a chain trained on labels.

    Null and empty texts have no words and get the base rates. Without labels of both classes there is
    no feature, all rows get the base rate and none is toxic. Repeated rows are returned as often as
    they come. An empty table gives no rows.
    """
    chain, _, targets = train(docs, labels, rows)
    if not len(targets) or targets[:, -1].min() == targets[:, -1].max():
        chain.threshold = 2.0
    return score(docs.select("doc_id", "text"), chain)

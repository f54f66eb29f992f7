"""Quality classifier without labels: overlapping heuristics, their accuracies by expectation
maximisation, and a hashed linear scorer trained on the posterior labels.

Eight labellers vote good, poor or nothing on a text. Texts are counted by their votes, at most 3^8
patterns whatever the corpus, and expectation maximisation on those counts estimates how often every
labeller votes what for good and for poor texts, all texts counting. The posterior of a text's votes
is its soft label. A logistic scorer on hashed words and word shapes learns the soft labels of a
bounded sample, so it generalises beyond what the heuristics look at; it scores every text.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import saved, words

FEATURES = 1 << 15
TRAIN_ROWS = 20_000  # bound of the sample that the scorer is fitted on
EM_ROUNDS = 100
KEEP_FROM = 0.5
SAME = 0.95
LEAST_GOOD = 0.97  # what the heuristics are made for: to say poor of few good texts
MIN_EDGE = 0.05  # a labeller that says good of good texts no more often than this above poor ones tells nothing
GOOD, POOR, NONE = 1, -1, 0


def _vote(poor: Column, good: Column) -> Column:
    return F.when(poor, POOR).when(good, GOOD).otherwise(NONE).cast("byte")


def _chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, __text, __words of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("__text"), words(text).alias("__words"))


def text_name() -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64("__text").alias("__k1"), F.xxhash64(F.lit("second"), "__text").alias("__k2")]


def votes(docs: DataFrame) -> DataFrame:
    """doc_id, __text, __words, vote_... of every row. Null texts count as empty. A map over rows."""
    split = texts(docs).withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.length(x) > 0))
    counted = split.select(
        "doc_id", "__text", "__words", F.size("__words").alias("n"),
        F.greatest(F.length(F.array_join("__words", "")), F.lit(1)).alias("chars"),
        F.size(F.array_distinct("__words")).alias("different"),
        F.size("__lines").alias("lines"), F.size(F.array_distinct("__lines")).alias("own_lines"),
        _chars(F.col("__text"), r"[^#*$%&|<>]+").alias("symbols"),
        _chars(F.col("__text"), r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("marks"),
        _chars(F.col("__text"), r"[^\p{Lu}]+").alias("capitals"),
        F.size(F.filter("__words", lambda w: w.rlike("[.!?]$"))).alias("ends"),
        F.size(F.filter("__words", lambda w, i: w == F.get("__words", i - 1))).alias("same"))
    n, chars, there = F.col("n"), F.col("chars"), F.col("n") > 0
    return counted.select(
        "doc_id", "__text", "__words",
        _vote(n < 3, n >= 60).alias("vote_length"),
        _vote(F.col("symbols") > 0.02 * chars, there & (F.col("symbols") == 0)).alias("vote_symbols"),
        _vote(F.col("marks") > 0.12 * chars, there & (F.col("marks") < 0.06 * chars)).alias("vote_marks"),
        _vote(F.col("capitals") > 0.3 * chars, there & (F.col("capitals") < 0.1 * chars)).alias("vote_capitals"),
        _vote((n >= 60) & (F.col("different") < 0.2 * n), (n >= 60) & (F.col("different") > 0.4 * n)).alias("vote_variety"),
        _vote(F.col("own_lines") < 0.7 * F.col("lines"), (F.col("lines") > 3) & (F.col("own_lines") == F.col("lines"))).alias("vote_lines"),
        _vote((n >= 60) & (F.col("ends") == 0), (F.col("ends") > 0.01 * n) & (F.col("ends") < 0.3 * n)).alias("vote_sentences"),
        _vote(F.col("same") > 0.1 * n, (n >= 20) & (F.col("same") <= 0.02 * n)).alias("vote_runs"))


VOTES = ("vote_length", "vote_symbols", "vote_marks", "vote_capitals", "vote_variety", "vote_lines",
         "vote_sentences", "vote_runs")


def posteriors(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS, least: float = 0.5
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of `good` per vote pattern, and how often every labeller that votes says `good` of
    poor and of good texts: array (labeller, class).

    Labellers are taken as independent given the class; a labeller that does not vote says nothing. One
    count is added to either vote, so that no share is zero. The names of the classes are anchored: the
    start is the share of a text's votes that say good, a labeller says good of at least the share `least`
    of good texts, and of poor texts no more often than of good ones. Where the votes would have it
    otherwise, the shares are equal, and the labeller says nothing. So a vote for good never speaks for
    poor, whatever the mix of texts; and a kind of poor texts that fills the corpus does not become the
    good class, as its labeller speaks against it. A labeller that says poor of nearly all (SAME) tells
    nothing of any text. If no labeller is left that tells the classes apart, the share of votes decides.
    """
    yes, no = (patterns == GOOD).astype(float), (patterns == POOR).astype(float)
    silent = counts @ no > SAME * (counts @ (yes + no))
    heard = ~silent if not silent.all() else silent
    start = (yes[:, heard].sum(axis=1) + 0.5) / ((yes + no)[:, heard].sum(axis=1) + 1)
    good = start
    says = np.full((patterns.shape[1], 2), 0.5)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good], axis=1)
        prior = (weight.sum(axis=0) + 1) / (counts.sum() + 2)
        agree, against = yes.T @ weight, no.T @ weight
        says = (agree + 1) / (agree + against + 2)
        pooled = (agree.sum(axis=1) + 1) / ((agree + against).sum(axis=1) + 2)
        crossed = says[:, 1] < says[:, 0]
        says[crossed] = pooled[crossed, None]
        says[:, 1] = np.maximum(says[:, 1], least)
        says[silent] = pooled[silent, None]
        log = np.log(prior) + yes @ np.log(says) + no @ np.log(1 - says)
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        change = np.abs(new - good).max(initial=0)
        good = new
        if change < 1e-9:
            break
    if not (says[:, 1] - says[:, 0] > MIN_EDGE).any():
        good = start
    return good, says


def soft_labels(voted: DataFrame) -> DataFrame:
    """VOTES and weak_good for every vote pattern of voted: at most 3^8 rows, also in the driver."""
    rows = sorted(tuple(r) for r in voted.groupBy(*VOTES).count().collect())
    patterns = np.array([r[:-1] for r in rows], np.int64).reshape(-1, len(VOTES))
    good, _ = posteriors(patterns, np.array([r[-1] for r in rows], float), least=LEAST_GOOD)
    ddl = ", ".join(f"{v} byte" for v in VOTES) + ", weak_good double"
    return voted.sparkSession.createDataFrame(
        [(*r[:-1], float(g)) for r, g in zip(rows, good)], ddl)


def terms(text: Column, found: Column) -> Column:
    """Words in lower case, the shape of every word (A capitals, a letters, 9 digits, marks as they
    are) and a mark for every word that repeats the one before."""
    shapes = F.regexp_replace(text, r"[\p{L}&&\P{Lu}]+", "a")
    shapes = F.regexp_replace(F.regexp_replace(shapes, r"\p{Lu}+", "A"), r"[0-9]+", "9")
    same = F.transform(
        F.filter(found, lambda w, i: w == F.get(found, i - 1)), lambda _: F.lit("\n=same"))
    return F.concat(
        F.transform(found, lambda w: F.lower(w)),
        F.transform(words(shapes), lambda s: F.concat(F.lit("\n"), s)), same)


def vectors(voted: DataFrame) -> DataFrame:
    """voted with `features` and `__blank` (no words): counts of hashed terms, scaled to length one (empty texts: zero)."""
    listed = voted.withColumn("__blank", F.size("__words") == 0).withColumn("__terms", terms(F.col("__text"), F.col("__words"))).drop("__text", "__words")
    hashed = HashingTF(numFeatures=FEATURES, inputCol="__terms", outputCol="__counts").transform(listed)
    return Normalizer(inputCol="__counts", outputCol="features").transform(hashed).drop("__terms", "__counts")


def trained(docs: DataFrame, labels: DataFrame, n: int, rows: int = TRAIN_ROWS) -> LogisticRegressionModel:
    """The scorer, from the soft labels of about `rows` of the n rows of docs, chosen by a hash."""
    share = min(1.0, rows / max(1, n))
    key = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30))
    sample = docs.filter(key < int(share * (1 << 30)))
    soft = vectors(votes(sample)).join(F.broadcast(labels), list(VOTES)).select("features", "weak_good")
    both = soft.select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("weak_good").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("weak_good")).alias("weight")))).alias("x"))
    train = saved(both.select("features", "x.label", "x.weight").filter("weight > 1e-4"), "quality-train")
    return LogisticRegression(
        maxIter=50, regParam=1e-4, weightCol="weight").fit(train)


def classify(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, weak_good, score, kept of every row of docs (doc_id, text).

    weak_good is the posterior of the row's votes, score the scorer's probability of good; kept from
    KEEP_FROM. Null and empty texts are texts without words; their score is zero. Repeated
    rows are returned as often as they come. Without texts there is nothing to fit and no row.
    """
    docs = docs.select("doc_id", "text")
    voted = saved(votes(docs).select("doc_id", *VOTES, *text_name()), "quality-votes")
    n = voted.count()
    if not n:
        return voted.select(
            "doc_id", F.lit(0.0).alias("weak_good"), F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    labels = soft_labels(voted)
    model = trained(docs, labels, n, rows)
    # Votes depend on the text alone: they come back by its name, small rows, and are not taken again.
    known = voted.join(F.broadcast(labels), list(VOTES)).groupBy("__k1", "__k2").agg(F.first("weak_good").alias("weak_good"))
    scored = model.transform(vectors(texts(docs).select("*", *text_name())))
    score = F.when(F.col("__blank"), 0.0).otherwise(F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "__k1", "__k2", score.alias("score")).join(known, ["__k1", "__k2"]).select(
        "doc_id", "weak_good", "score").withColumn("kept", F.col("score") >= KEEP_FROM)

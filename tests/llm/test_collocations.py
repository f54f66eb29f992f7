"""Collocations against counting every phrase; tries against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fichario.llm import collocations
from fichario.llm.catalog import op13_collocations


def slow(rows, least=10, top=2_000):
    """rows: (lang, text)."""
    sizes = {}
    for lang, text in rows:
        own = sizes.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in sizes.items():
        n, found = sum(c for w, c in own.items() if len(w) == 1), []
        frequent = {w: c for w, c in own.items() if len(w) > 1 and c >= least}
        longer = {}
        for w, c in frequent.items():
            if len(w) == 3:
                for part in (w[:2], w[1:]):
                    longer[part] = max(longer.get(part, 0), c)
        for w, a in frequent.items():
            if 100 * longer.get(w, 0) >= 50 * a:
                continue
            cuts = [(10 ** 6 * a * a // (own[w[:k]] * own[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(w).encode(), own[w[:k]], own[w[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def listed(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_query_against_counting(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()
    want = slow(rows)
    assert want and listed(op13_collocations(spark, folder)) == want


@pytest.mark.parametrize("most", [8, 1_000_000])
def test_many_tries(spark, most):
    random.seed(most)
    names = ["a", "B", "the", "é", "x\x1fy", "日本", "\xa0", "New", "york"]
    rows = [(random.choice(["en", "und", None, ""]), random.choice([" ", "\t", ", ", ". ", " \n"]).join(
        random.choices(names, weights=[9, 5, 5, 3, 1, 2, 1, 4, 4], k=random.randrange(40)))) for _ in range(250)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert listed(collocations.collocations(docs, least=5, top=12, most=most)) == slow(rows, 5, 12)


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, "a b"), (None, "a b " * 30_000), ("de", "e f. e f"), ("fr", "..., !!")]
    rows += [("es", "uno dos tres")] * 12
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit(2))
    assert listed(collocations.collocations(docs)) == slow(rows)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_trie_holds_its_phrases_and_no_other():
    random.seed(1)
    words = [f"w{n}".encode() for n in range(3_000)]
    weights = [1 / (n + 1) for n in range(3_000)]
    phrases = sorted({b" ".join(random.choices(words, weights, k=random.choice([2, 3]))) for _ in range(20_000)})
    book = collocations.Trie(["en"] * len(phrases), phrases, np.arange(len(phrases)))
    found = random.choices(words + [b"."], weights + [0.3], k=30_000) + [b"."]
    symbols = book.read("en", found)
    at, states = book.pairs(symbols)
    got = Counter(phrases[n - 1] for n in book.accept[states] if n)
    _, states = book.advance(at, states, symbols, 2)
    got.update(phrases[n - 1] for n in book.accept[states] if n)
    known, want = set(phrases), Counter()
    for k in (2, 3):
        want.update(p for i in range(len(found)) if (p := b" ".join(found[i:i + k])) in known)
    assert got == want and len(book.base) < 4 * len(phrases) + 8_000
    assert book.read("fr", found) is None


def test_passes_over_the_texts_do_not_grow_with_the_phrases(spark):
    random.seed(3)
    rows = [("en", " ".join(random.choices([f"w{n}" for n in range(30)], k=60))) for _ in range(200)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    texts = counted.asNondeterministic()(F.col("text")).alias("text")
    docs = spark.createDataFrame(rows, "lang string, text string").select("lang", texts)
    for most in (10, 1_000_000):
        before = read.value
        assert listed(collocations.collocations(docs, least=3, most=most)) == slow(rows, 3)
        assert read.value - before <= 3 * len(rows)


def test_blocks_of_many_runs(monkeypatch):
    """Runs dealt into blocks and summed give the counts of all phrases of numbered words."""
    import pyarrow as pa

    monkeypatch.setattr(collocations, "RUN_TOKENS", 500)
    monkeypatch.setattr(collocations, "BLOCK_ROWS", 40)
    random.seed(4)
    names = [f"w{n}".encode() for n in range(40)]
    texts = [b" ".join(random.choices(names, [1 / (n + 1) for n in range(40)], k=random.randrange(30))) for _ in range(400)]
    texts += [b"w0 w1 " * 300]
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * len(part), "text": [t.decode() for t in part]})
               for part in (texts[:150], texts[150:160], texts[160:])]

    class Sent:
        value = {"en": collocations.Numbered(pa.array(names[:25], pa.binary()), 7)}

    dealt = pa.Table.from_batches(collocations._dealt(Sent)(iter(batches))).sort_by([("lang", "ascending"), ("block", "ascending")])
    assert len(set(dealt["block"].to_pylist())) == 7 and dealt.num_rows >= 14
    got, want = Counter(), Counter()
    for part in collocations._summed(Sent, 5)(dealt.to_batches(3)):
        for phrase, n in zip(part["phrase"].to_pylist(), part["n"].to_pylist()):
            assert phrase not in got
            got[phrase] = n
    known = set(names[:25])
    for text in texts:
        words = text.split()
        for k in (2, 3):
            want.update(b" ".join(words[i:i + k]).decode() for i in range(len(words) - k + 1) if known.issuperset(words[i:i + k]))
    assert got == {phrase: n for phrase, n in want.items() if n >= 5}

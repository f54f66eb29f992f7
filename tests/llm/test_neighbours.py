"""Neighbours found against brute force: recall, exact scores, ties and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fichario.llm import neighbours
from fichario.llm.catalog import op12_nearest_neighbours

SCHEMA = "vec_id long, embedding array<double>"


def exact(ids, vectors, asks, k=10):
    """{query: [(vec_id, score)]} by all distances."""
    out = {}
    for n in np.flatnonzero(asks):
        score = np.sqrt(((vectors - vectors[n]) ** 2).sum(1))
        order = [m for m in np.lexsort((ids, score)) if m != n][:k]
        out[int(ids[n])] = [(int(ids[m]), float(score[m])) for m in order]
    return out


def listed(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def hits(found, want):
    return sum(len({i for i, _ in found[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1", "/root/testdata/check_s"])
def test_whole_query_against_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = exact(ids, vectors, ids % 100 == 0)
    found = listed(op12_nearest_neighbours(spark, folder))
    assert found.keys() == want.keys() and all(len(f) == 10 for f in found.values())
    assert hits(found, want) >= 0.95
    place = {int(i): n for n, i in enumerate(ids)}
    for query, near in found.items():
        for vec_id, score in near:
            assert vec_id != query
            assert score == pytest.approx(np.linalg.norm(vectors[place[query]] - vectors[place[vec_id]]), rel=1e-12)


def clustered(n, dim, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(40, dim))
    return centres[random.integers(40, size=n)] + 0.05 * random.normal(size=(n, dim))


@pytest.mark.parametrize("block_rows, dim", [(64, 9), (2_048, 2), (300, 1)])
def test_small_blocks_and_odd_lengths(spark, block_rows, dim):
    vectors = clustered(1_500, dim)
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], SCHEMA)
    found = listed(neighbours.search(frame, F.col("vec_id") % 50 == 0, block_rows=block_rows, sample_rows=500))
    want = exact(np.arange(1_500), vectors, np.arange(1_500) % 50 == 0)
    assert found.keys() == want.keys() and hits(found, want) >= 0.9


def test_clusters_are_searched_in_part():
    vectors = clustered(4_000, 16)
    book = neighbours.Codebook(vectors, 10, 0.985)
    assert book.share < 0.3
    first, second = (h[0] for h in book.halves(vectors[:1]))
    sizes = np.bincount(book.cell(vectors), minlength=book.cells)
    cells = book.walk(first, second, sizes.tolist(), np.inf)
    sums = [first[c // book.width] + second[c % book.width] for c in cells]
    assert sums == sorted(sums) and sorted(cells) == np.flatnonzero(sizes).tolist()


def test_a_third_of_all_rows_alike(spark):
    """Ties go to the smaller id; the cell of the copies is dealt to several blocks."""
    vectors = clustered(900, 8)
    vectors[::3] = vectors[0]
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], SCHEMA)
    found = listed(neighbours.search(frame, F.col("vec_id") % 100 == 0, block_rows=50))
    want = exact(np.arange(900), vectors, np.arange(900) % 100 == 0)
    for query in range(0, 900, 300):
        assert found[query] == [(i, 0.0) for i in range(0, 33, 3) if i != query][:10]
    assert found.keys() == want.keys() and hits(found, want) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.0]), (3, [1.0, 0.0, 0.5]), (None, [1.0, 0.0, 0.0]),
            (200, None), (300, [0.0, 0.0, 0.0]), (400, [nan, 1.0, 1.0]), (500, [inf, 1.0, 1.0]), (600, [None, 1.0, 1.0]),
            (700, [1.0]), (800, [])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("cell", F.lit(1))
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in
             neighbours.search(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    far, near = 2 ** 0.5, 0.5
    assert found[:4] == [(0, 1, None, 0.0), (0, 2, 3, near), (0, 3, 100, far), (0, 4, 100, far)]
    assert sorted(found[4:], key=lambda r: r[1:2] + (r[2] or 0,)) == [
        (100, 1, 100, 0.0), (100, 1, 100, 0.0), (100, 2, 0, far), (100, 2, 0, far), (100, 3, None, far),
        (100, 3, None, far), (100, 4, 3, 1.5), (100, 4, 3, 1.5)]
    for n in (0, 1):
        few = neighbours.search(frame.limit(n), F.col("vec_id") % 100 == 0)
        assert few.columns == ["query_id", "rank", "vec_id", "score"] and few.count() == 0

"""Nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, with CENTROIDS centroids each, so that a pair of
centroids is one of CENTROIDS^2 cells. A query walks the pairs in the order of their summed squared
distances, taken from a heap, until the cells walked hold a share of all rows; the rows of these cells
are reranked by the exact distance. Centroids and the share are fitted on a bounded sample (SAMPLE_ROWS
and SAMPLE_VALUES): the share is what its own neighbours need at the wanted recall. As neighbours
among all rows are nearer than those among a sample, the share errs to the safe side.

Every row is indexed. Cells are packed into blocks of about BLOCK_ROWS rows, a cell with more rows is
dealt to several blocks by a hash of the row; a query is sent to each block that holds a cell of its
walk, with these cells. In a task a block comes first and its queries stream past it, so what is held
is one block and one batch. No pair leaves a task but the nearest of a query in a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fichario.llm.common import saved, small_batches

CENTROIDS = 64
SAMPLE_ROWS = 16_384
SAMPLE_VALUES = 4_000_000
SAMPLE_QUERIES = 256
FIT_ROUNDS = 12
BLOCK_ROWS = 2_048
RECALL = 0.985  # aimed at on the sample; at least 0.9 is promised


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """vectors with __vec array<double> of the rows whose vector takes part: not null, not zero, all
    components finite. Of several lengths the most frequent one counts (of equally frequent the longest)."""
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.withColumn("__vec", vec).filter(finite & F.exists(vec, lambda x: x != 0))
    lengths = rows.groupBy(F.size("__vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).take(1)
    return rows.filter(F.size("__vec") == (lengths[0].dim if lengths else 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product: for ordering cells, not for results."""
    return np.maximum(
        (points * points).sum(1)[:, None] + (centres * centres).sum(1) - 2 * points @ centres.T, 0)


def fit(points: np.ndarray, count: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """At most `count` centroids of points: k-means from seeds that lie apart."""
    random = np.random.default_rng(7)
    centres = points[random.integers(len(points))][None]
    nearest = squared(points, centres)[:, 0]
    while len(centres) < count and nearest.max() > 1e-12 * max(1.0, (points * points).sum(1).max(initial=0)):
        chosen = random.choice(len(points), p=nearest / nearest.sum())
        centres = np.vstack([centres, points[chosen]])
        nearest = np.minimum(nearest, squared(points, centres[-1:])[:, 0])
    for _ in range(rounds):
        own = squared(points, centres).argmin(1)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


class Codebook:
    """Centroids of both halves and how far a query walks."""

    def __init__(self, sample: np.ndarray, k: int, recall: float, centroids: int = CENTROIDS):
        self.dim, self.cut = sample.shape[1], (sample.shape[1] + 1) // 2
        self.centres = [fit(half, centroids) for half in (sample[:, :self.cut], sample[:, self.cut:])]
        self.width = len(self.centres[1])
        self.cells = len(self.centres[0]) * self.width
        self.share = self._share(sample, k, recall)

    def halves(self, points: np.ndarray) -> list[np.ndarray]:
        return [squared(half, c) for half, c in zip((points[:, :self.cut], points[:, self.cut:]), self.centres)]

    def cell(self, points: np.ndarray) -> np.ndarray:
        first, second = self.halves(points)
        return first.argmin(1) * self.width + second.argmin(1)

    def walk(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray, rows: float) -> list[int]:
        """Cells in the order of the summed distances until they hold `rows` rows; empty ones are left out."""
        left, right = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = first[left].tolist(), second[right].tolist()
        left, right = left.tolist(), right.tolist()
        heap, cells, held = [(a[0] + b[0], 0, 0)], [], 0
        while heap and held < rows:
            _, i, j = heapq.heappop(heap)
            cell = left[i] * self.width + right[j]
            if sizes[cell]:
                cells.append(cell)
                held += sizes[cell]
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return cells

    def _share(self, sample: np.ndarray, k: int, recall: float) -> float:
        """Share of rows that the walk must hold so that `recall` of the sample's neighbours are met."""
        own = self.cell(sample)
        sizes = np.bincount(own, minlength=self.cells)
        random = np.random.default_rng(11)
        needed = []
        for at in random.permutation(len(sample))[:SAMPLE_QUERIES]:
            distance = ((sample - sample[at]) ** 2).sum(1)
            distance[at] = np.inf
            near = np.argsort(distance, kind="stable")[:min(k, len(sample) - 1)]
            first, second = (h[0] for h in self.halves(sample[at:at + 1]))
            cells = self.walk(first, second, sizes.tolist(), np.inf)
            held = np.zeros(self.cells)
            held[cells] = np.cumsum(sizes[cells])
            needed.append(held[own[near]] / len(sample))
        needed = np.concatenate(needed) if needed else np.empty(0)
        return float(np.quantile(needed, recall, method="higher")) if len(needed) else 1.0


def nearest(block: np.ndarray, keys: np.ndarray, ids: np.ndarray, query: np.ndarray, approx: np.ndarray,
            open_: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the k nearest open rows of a block, ties by id (null ids last)."""
    at = np.flatnonzero(open_)
    if len(at) > k:
        bound = np.partition(approx[at], k - 1)[k - 1] + slack
        if np.isfinite(bound):
            at = at[approx[at] <= bound]
    exact = np.sqrt(((block[at] - query) ** 2).sum(1))
    order = np.lexsort((keys[at], ids[at], exact))[:k]
    return at[order], exact[order]


def _search(dim: int, k: int):
    """Rows (block, kind, row, id, cells, vec), sorted; a block's rows first, then its queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, stacked = None, None
        for batch in batches:
            blocks, kinds = (batch.column(c).to_numpy() for c in ("block", "kind"))
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                vec, rows = _matrix(part.column("vec"), dim), part.column("row").to_numpy()
                if kinds[low] == 0:
                    if blocks[low] != now:
                        held, now = [], blocks[low]
                    held.append((vec, rows, part.column("id"), part.column("cell").to_numpy()))
                    stacked = None
                    continue
                if blocks[low] != now:
                    continue  # a block whose rows are none of ours: it has none
                if stacked is None:
                    ids = pa.concat_arrays([h[2] for h in held])
                    stacked = (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), ids,
                               ids.fill_null(np.iinfo(np.int64).max).to_numpy(), np.concatenate([h[3] for h in held]))
                    norms = (stacked[0] ** 2).sum(1)
                    there = set(stacked[4].tolist())
                block, keys, ids, order, cells = stacked
                own = (vec * vec).sum(1)
                approx = own[:, None] + norms - 2 * vec @ block.T
                out = []
                for n, (row, walked) in enumerate(zip(rows.tolist(), part.column("cells").to_pylist())):
                    open_ = keys != row
                    if not there <= set(walked):
                        open_ &= np.isin(cells, walked)
                    at, score = nearest(block, keys, order, vec[n], approx[n], open_, k,
                                        1e-9 * (own[n] + norms.max()))
                    out.append((np.full(len(at), n), at, score))
                which, at, score = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_pydict({
                    "query_row": pa.array(rows[which]), "query_id": part.column("id").take(pa.array(which)),
                    "vec_id": ids.take(pa.array(at)), "score": pa.array(score, pa.float64()),
                    "row": pa.array(keys[at])})

    return search


def search(vectors: DataFrame, queries: Column, k: int = 10, vector: str = "embedding", recall: float = RECALL,
           block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each row where `queries` holds.

    vectors (vec_id, and the vector): score is the Euclidean distance of the original vectors in double
    precision, ties go to the smaller vec_id. Rows with a null or zero vector, null or non-finite
    components or another length than most take no part. A row without vec_id is found (last among ties)
    but is no query. A row is not its own neighbour; of rows that repeat a vec_id each is a row of its
    own: each is a query with its own ranks, and finds the others. Fewer candidates than k: all of them.
    An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark, 1_000)
    given = usable(vectors.select("vec_id", F.col(vector).alias("__given"), queries.alias("__asks")), "__given")
    given = given.select(F.col("vec_id").cast("long").alias("id"), (F.col("__asks") & F.col("vec_id").isNotNull()).alias("asks"),
                         F.col("__vec").alias("vec"))
    n = given.count()
    shape = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], shape)
    dim = given.select(F.size("vec").alias("dim")).first().dim
    wanted = max(1, min(sample_rows, SAMPLE_VALUES // dim))
    picked = given.select("vec") if n <= wanted else (
        given.select("vec").filter(F.rand(7) < wanted / n).limit(2 * wanted))
    book = Codebook(_matrix(picked.toArrow().column("vec"), dim), k, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = book.cell(_matrix(batch.column("vec"), dim)).astype(np.int32)
            yield batch.append_column("cell", pa.array(cell))

    index = saved(
        given.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(place, "id long, asks boolean, vec array<double>, row long, cell int"), "multi-index")

    sizes = np.zeros(book.cells, np.int64)  # one number per cell, whatever the rows
    for cell, count in index.groupBy("cell").count().collect():
        sizes[cell] = count
    first, parts = layout(sizes, block_rows)
    by_cell = spark.createDataFrame(
        pd.DataFrame({"cell": np.arange(book.cells, dtype=np.int32), "first": first, "parts": parts}),
        "cell int, first long, parts long")
    held, rows_needed = sizes.tolist(), max(book.share * n, k + 1)

    def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = book.halves(np.stack(batch["vec"].to_numpy()).astype(float))
            for n, (row, key, vec) in enumerate(zip(batch["row"], batch["id"], batch["vec"])):
                by_block: dict[int, list[int]] = {}
                for cell in book.walk(left[n], right[n], held, rows_needed):
                    for block in range(first[cell], first[cell] + parts[cell]):
                        by_block.setdefault(block, []).append(cell)
                yield pd.DataFrame({"block": list(by_block), "row": row, "id": key, "vec": [vec] * len(by_block),
                                    "cells": list(by_block.values())})

    asked = index.filter("asks").select("row", "id", "vec").mapInPandas(
        routes, "block long, row long, id long, vec array<double>, cells array<int>")
    stored = index.join(F.broadcast(by_cell), "cell").select(  # CENTROIDS^2 rows
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).alias("block"), F.lit(0).alias("kind"), "row",
        "id", "cell", "vec", F.lit(None).cast("array<int>").alias("cells"))
    both = stored.unionByName(asked.select(
        "block", F.lit(1).alias("kind"), "row", "id", F.lit(None).cast("int").alias("cell"), "vec", "cells"))
    found = (
        both.repartition("block").sortWithinPartitions("block", "kind")
        .mapInArrow(_search(dim, k), "query_row long, query_id long, vec_id long, score double, row long"))
    order = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def layout(sizes: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell: small neighbouring cells share a block, a large
    one has blocks of its own."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, held = 0, 0
    for cell, size in enumerate(sizes.tolist()):
        if held and held + size > block_rows:
            block, held = block + 1, 0
        first[cell] = block
        if size > block_rows:
            parts[cell] = -(-size // block_rows)
            block += int(parts[cell])
        else:
            held += size
    return first, parts


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact (query_id, vec_id) pairs that were found."""
    both = exact.select("query_id", "vec_id").join(
        found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    row = both.agg(F.count("*").alias("n"), F.sum(F.coalesce("hit", F.lit(0))).alias("hits")).first()
    return row.hits / row.n if row.n else 1.0

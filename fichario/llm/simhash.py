"""Near duplicates: 64-bit fingerprints, multi-index hashing over Hamming balls, components.

A fingerprint is cut into two halves. Two fingerprints that differ in at most three bits differ in
at most one bit in one of the halves, so the ball of radius one around a half, looked up in the
table of the halves, meets every linked pair. Only balls' points reached by setting a bit are
looked up: of two halves one bit apart, one reaches the other that way. Everything met is verified
on all 64 bits.

Equal fingerprints are one row before any of this. A bucket is linked by a spanning forest, never by
all its pairs. A bucket beyond a size is not worked in one task: its rows are dealt again by the same
rule on the half that is still free, then on the free quarter, where a bucket is small by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fichario.llm.common import connected_components, saved, small_batches, text_key

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BUCKET_ROWS = 4_096
LEVELS = 3


def fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint of a text; null and blank texts have zero."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and space
    if not found:
        return 0
    flat = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE_WORDS, len(found))
    count = len(found) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, 16_384):  # bounds the bit table of a very long text
        high = min(count, low + 16_384)
        hashes = np.fromiter(
            (digest(flat[s:e], SEED) for s, e in zip(
                starts[low:high].tolist(), ends[low + width - 1:high + width - 1].tolist())),
            np.uint64, high - low)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _free(path: np.ndarray, level: int) -> np.ndarray:
    """First bit of the range that the choices in path leave free before the given level."""
    start, width = np.zeros(len(path), np.uint64), 64
    for step in range(level):
        width //= 2
        chosen = (path >> np.int64(step)) & np.int64(1)
        start = start + np.where(chosen == 1, 0, width).astype(np.uint64)
    return start


def _deal(level: int):
    """Rows (path, key, fp): table row and ball of both halves of the range that is free."""
    width = 64 >> (level + 1)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.uint64((1 << width) - 1)
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            path = batch["path"].to_numpy(np.int64)
            key = batch["key"].to_numpy(np.int64)
            free = _free(path, level)
            for half in (0, 1):
                value = (fp.view(np.uint64) >> (free + np.uint64(half * width))) & mask
                into = path | np.int64(half << level)
                base = (key << np.int64(width)) if level else np.zeros(len(fp), np.int64)
                yield pd.DataFrame({"path": into, "key": base | value.astype(np.int64), "fp": fp})
                for bit in range(width):
                    clear = (value >> np.uint64(bit)) & np.uint64(1) == 0
                    reach = (value | np.uint64(1 << bit)).astype(np.int64)
                    yield pd.DataFrame({
                        "path": into[clear], "key": (base | reach)[clear], "fp": fp[clear]})

    return deal


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among fingerprints; memory linear in their number."""
    left, edges = np.unique(fps), []
    bits = left.view(np.uint64)
    open_ = np.ones(len(left), bool)
    while open_.any():
        queue = [int(np.argmax(open_))]
        open_[queue[0]] = False
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(open_)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= MAX_BITS]
            open_[near] = False
            edges += [(int(left[at]), int(left[x])) for x in near]
            queue += near.tolist()
    return edges


def _starts(rows: np.ndarray) -> np.ndarray:
    """Where a new bucket begins in rows (path, key, fp) sorted by bucket."""
    return np.flatnonzero(np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0))))


def _bucket_links(rows: np.ndarray, level: int) -> list[tuple[int, int]]:
    """Links that span each whole bucket of rows."""
    path, key, fp = rows
    width = 64 >> (level + 1)
    low = np.uint64((1 << width) - 1)
    half = (path >> np.int64(level)) & np.int64(1)
    value = fp.view(np.uint64) >> (_free(path, level) + (half * width).astype(np.uint64))
    stands = (value & low) == (key.view(np.uint64) & low)  # a table row, not a point of a ball
    begin = _starts(rows)
    sizes = np.diff(np.append(begin, len(fp)))
    use = (sizes > 1) & (np.add.reduceat(stands.astype(np.int64), begin) > 0)
    two = begin[use & (sizes == 2)]
    bits = fp.view(np.uint64)
    two = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= MAX_BITS]
    edges = list(zip(fp[two].tolist(), fp[two + 1].tolist()))
    for at, size in zip(begin[use & (sizes > 2)].tolist(), sizes[use & (sizes > 2)].tolist()):
        edges += forest(fp[at:at + size])
    return edges


def _link(level: int, most: int):
    """Rows (path, key, fp) sorted by bucket -> links (a, b); rows of buckets over `most` pass on."""
    most = 1 << 62 if level == LEVELS - 1 else most

    def passed(rows: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"link": False, "path": rows[0], "a": rows[1], "b": rows[2]})

    def closed(rows: np.ndarray) -> Iterator[pd.DataFrame]:
        sizes = np.diff(np.append(_starts(rows), rows.shape[1]))
        large = np.repeat(sizes > most, sizes)
        if large.any():
            yield passed(rows[:, large])
        if not large.all():
            edges = np.array(_bucket_links(np.ascontiguousarray(rows[:, ~large]), level), np.int64)
            a, b = edges.reshape(-1, 2).T
            yield pd.DataFrame({"link": True, "path": np.zeros_like(a), "a": a, "b": b})

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, over = np.empty((3, 0), np.int64), None
        for batch in batches:
            rows = np.concatenate(
                [held, batch[["path", "key", "fp"]].to_numpy(np.int64).T], axis=1)
            if over is not None:  # the rest of a bucket that is passed on
                more = (rows[0] == over[0]) & (rows[1] == over[1])
                if more.any():
                    yield passed(rows[:, more])
                rows = rows[:, ~more]
            if not rows.shape[1]:
                continue
            last = _starts(rows)[-1]
            held, over = rows[:, last:], None
            if last:
                yield from closed(rows[:, :last])
            if held.shape[1] > most:
                yield passed(held)
                held, over = held[:, :0], (held[0, 0], held[1, 0])
        if held.shape[1]:
            yield from closed(held)

    return link


def links(fps: DataFrame, most: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) links that span the components of the distinct fingerprints fps (fp)."""
    spark = fps.sparkSession
    small_batches(spark, 20_000)
    state, found = fps.select(
        F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("key"), "fp"), []
    for level in range(LEVELS):
        dealt = state.mapInPandas(_deal(level), "path long, key long, fp long")
        result = saved(
            dealt.repartition("path", "key").sortWithinPartitions("path", "key")
            .mapInPandas(_link(level, most), "link boolean, path long, a long, b long"), "links")
        found.append(result.filter("link").select("a", "b"))
        state = result.filter("not link").select("path", F.col("a").alias("key"), F.col("b").alias("fp"))
        if level + 1 == LEVELS or state.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _members(docs: DataFrame, most: int) -> DataFrame:
    """doc_id, text_key, fp, root, component_id of every row; root names the component."""
    small_batches(docs.sparkSession)
    marked = saved(
        docs.select("doc_id", text_key().alias("text_key"), fingerprint_of("text").alias("fp")),
        "fingerprints")
    first = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(links(first.select("fp"), most))
    known = saved(
        first.join(roots.select(F.col("id").alias("fp"), "root"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp")), "members")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = saved(known.join(least, "root").select("fp", "root", "component_id"), "components")
    return marked.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, most: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id of every row of docs (doc_id, text).

    component_id is the smallest doc_id that links of at most three differing bits reach. Null and
    blank texts have fingerprint zero and are linked like any other; rows without doc_id link others
    but name no component (null where no member has an id). Repeated rows are returned as often as
    they come. An empty table gives no rows.
    """
    return _members(docs, most).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, most: int = BUCKET_ROWS) -> DataFrame:
    """Documents without near duplicates: one row of each component stays, with its columns.

    It is the row with the smallest doc_id (a null id comes last), then the smallest text hash; of
    rows that repeat both one stays.
    """
    found = _members(docs.select("doc_id", "text"), most)
    row = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("text_key").alias("k"))
    kept = saved(
        found.groupBy("root", "doc_id", "text_key").count()
        .groupBy("root").agg(F.min(F.struct(row.alias("r"), F.col("count").alias("c"))).alias("m"))
        .select(F.col("m.r.i").alias("__id"), F.col("m.r.k").alias("__key"), F.col("m.c").alias("__n")),
        "kept")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key"))
    several = kept.filter("__n > 1")
    if several.isEmpty():
        return docs.join(kept, same, "left_semi")
    again = docs.join(several, same).dropDuplicates(["__id", "__key"]).select(docs.columns)
    return docs.join(kept.filter("__n = 1"), same, "left_semi").unionByName(again)

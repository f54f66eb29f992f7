"""What several operators share: words, row keys, saved stages, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario.session import new_folder

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | Column = "text") -> Column:
    """Words of a whole text; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def text_key(text: str = "text") -> Column:
    """Hash of a text; with doc_id it names a row also where ids are null or repeat."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def saved(df: DataFrame, label: str) -> DataFrame:
    """Writes a stage to the shared folder and reads it back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bounds what a Python worker holds at once: rows per Arrow batch of the plans made from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Bounds rows and bytes of the Arrow batches of what runs inside; the session's settings come back."""
    wanted = {"maxRecordsPerBatch": rows, "maxBytesPerBatch": size}
    before = {key: spark.conf.get(f"spark.sql.execution.arrow.{key}") for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of edges (a, b); root is one node of its component.

    Contraction: every node points to the neighbour (or itself) that comes first in a random order,
    edges are rewritten to the targets, loops and repeats go, until none is left. The random order
    makes the number of rounds logarithmic whatever the ids are. Nothing is collected; degrees are
    aggregated before the shuffle, and both sides of every join are read from saved tables, so that
    adaptive execution splits a node with very many edges. Empty edges give no rows.
    """
    left = saved(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b").distinct(), "edges")
    maps = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id"))
        point = saved(
            both.groupBy("a").agg(F.min(order).alias("m"))
            .select(F.col("a").alias("id"), F.least("m", own).getField("id").alias("to")), "point")
        maps.append(point)
        new = (
            left.join(point.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
            .join(point.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
            .filter("x <> y")
        )
        left = saved(
            new.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges")
    if not maps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    roots = maps[0].select("id", F.col("to").alias("root"))
    for point in maps[1:]:
        step = point.select(F.col("id").alias("root"), "to")
        roots = roots.join(step, "root", "left").select(
            "id", F.coalesce("to", "root").alias("root"))
    return saved(roots, "roots") if len(maps) > 1 else roots

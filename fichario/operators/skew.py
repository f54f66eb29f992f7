"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits skewed joins only when both join inputs come straight from a shuffle.
Where one side is an aggregate, or several joins share one partitioning, hot keys are spread here
instead: rows of a hot key get a salt derived from their own identity (so repeated attempts of a
task give the same rows), and the matching rows of the other side are copied once per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with fewer rows than this fits one task; a larger one is cut into parts of about this size.
HOT_ROWS = 1_000_000
NULL_SALTS = 4_096


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All keys of ``counts`` (key, n) with at least ``hot_rows`` rows, and their number of salts.

    There are at most (rows / hot_rows) of them, so the list may be broadcast: a table of 1e12 rows
    gives a million entries at the most, some 40 MB.
    """
    return counts.filter((F.col("n") >= hot_rows) & F.col(key).isNotNull()).select(
        F.col(key).alias("_hot_key"), F.ceil(F.col("n") / hot_rows).cast("int").alias("_salts")
    )


def add_salt(rows: DataFrame, key: str, hot: DataFrame, identity: list[str]) -> DataFrame:
    """Many side: rows of a hot key are spread over its salts in ``_salt``, others get 0. Rows
    without a key match nothing and are spread as well."""
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    salts = F.when(F.col(key).isNull(), NULL_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = F.pmod(F.xxhash64(*identity), salts).cast("int")
    return marked.withColumn("_salt", spread).drop("_hot_key", "_salts")


def copy_per_salt(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """One side: rows of a hot key are copied for every salt, others keep salt 0."""
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return marked.withColumn("_salt", F.explode(salts)).drop("_hot_key", "_salts")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    identity: list[str],
    how: str = "inner",
    *,
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``many`` to ``one`` on ``key`` with hot keys of ``many`` spread.

    ``counts`` (key, n) may be passed when the caller has already counted the keys.
    """
    hot = hot_keys(key_counts(many, key) if counts is None else counts, key, hot_rows)
    salted = add_salt(many, key, hot, identity)
    copies = copy_per_salt(one, key, hot)
    return salted.join(copies, [key, "_salt"], how).drop("_salt")

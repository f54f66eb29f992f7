"""Tables stored bucketed and sorted by company root, so that what joins on the root does not shuffle.

A bucket is read by one task, so roots with very many branches or partners do not go into buckets: their
rows are stored beside them, spread as they come. The list of these roots is made once, when the tables
are stored (it holds at most rows / hot_rows roots), and all tables are split by the same list: buckets
join buckets, and the rows of hot roots join the one row per hot root of the other table, which is
broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fichario.operators import skew

KEY = "cnpj_basico"


@dataclass
class ByRoot:
    """cold: bucketed table; hot: rows of hot roots, None if there is no hot root."""

    cold: DataFrame
    hot: DataFrame | None = None

    def all(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def map(self, change) -> ByRoot:
        """The same change on both parts; it must keep the key."""
        return ByRoot(change(self.cold), None if self.hot is None else change(self.hot))


def hot_roots(tables: Iterable[DataFrame], hot_rows: int = skew.HOT_ROWS) -> list[str]:
    """Roots with at least hot_rows rows in any of the tables: at most rows / hot_rows, also in the driver."""
    found = None
    for table in tables:
        own = skew.hot_keys(skew.key_counts(table, KEY), KEY, hot_rows).select("_hot_key")
        found = own if found is None else found.unionByName(own)
    return [] if found is None else sorted(row[0] for row in found.distinct().collect())


def store(rows: DataFrame, path: str, buckets: int, hot: list[str]) -> ByRoot:
    """Writes rows under path, which must be new; rows without a root count as hot, as they join nothing."""
    spark, name = rows.sparkSession, f"by_root_{uuid.uuid4().hex}"
    keys = spark.createDataFrame([(key,) for key in hot], "_hot string")
    marked = rows.join(F.broadcast(keys), F.col(KEY) == F.col("_hot"), "left")
    cold = marked.filter(F.col("_hot").isNull()).drop("_hot") if hot else rows
    (cold.repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
     .option("path", f"{path}/cold").saveAsTable(name))
    if not hot:
        return ByRoot(spark.table(name))
    marked.filter(F.col("_hot").isNotNull()).drop("_hot").write.parquet(f"{path}/hot")
    return ByRoot(spark.table(name), spark.read.schema(rows.schema).parquet(f"{path}/hot"))


def join(many: ByRoot, one: ByRoot, how: str = "inner") -> ByRoot:
    """Joins on the root; `one` has a row per root (for left_semi: any number). Left side: many."""
    cold = many.cold.join(one.cold, KEY, how)
    if many.hot is None:
        return ByRoot(cold)
    single = one.hot.select(KEY).distinct() if how == "left_semi" else one.hot
    return ByRoot(cold, many.hot.join(F.broadcast(single), KEY, how))  # a row per hot root

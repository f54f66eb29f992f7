"""Merges that tell what changed, and counts kept by these changes.

A table keeps a hash of each row's content. A merge compares hashes, not columns, and gives change rows:
the key, what happened, the row before and the row after. Applying them writes only rows whose content
is another; all others keep their time stamps. Counts over the table then need no recount: a change
takes one from the value before and adds one to the value after, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.operators.upsert import latest_per_key

HASH = "row_hash"
STAMPS = ("updated_at", "source_competence", HASH)
INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


def content_hash(columns: list[str]) -> Column:
    """Digest of the named columns, null and empty text apart."""
    rest = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.md5(rest.cast("binary"))


def hashed(rows: DataFrame, key: str, stamps: tuple[str, ...] = STAMPS) -> DataFrame:
    """rows with the hash of their content: all columns but the key and the time stamps."""
    return rows.withColumn(HASH, content_hash([c for c in rows.columns if c not in (key, *stamps)]))


def merge_changes(
    base: DataFrame, updates: DataFrame, key: str, now: Column, order: list[str] | None = None,
    stamps: tuple[str, ...] = STAMPS,
) -> DataFrame:
    """Change rows of a merge: key, change, before (null if inserted) and after, structs of base's columns.

    base carries `row_hash` (see `hashed`); it has a row per key. Of updates with one key the last in
    `order` counts (without an order keys must not repeat); columns they do not carry keep their stored
    value. Rows whose content stays are `unchanged` and their `after` is the stored row, stamps included.
    Rows of base that no update names give no change row. A null key matches nothing and is left out.
    """
    columns = [c for c in base.columns if c != HASH]
    given = updates.filter(F.col(key).isNotNull())
    if order:
        given = latest_per_key(given, key, order)
    carried = [c for c in given.columns if c in columns and c != key]
    new = given.select(key, F.struct(*carried).alias("_new"))
    old = base.select(key, F.struct(*base.columns).alias("before"))
    both = new.join(old, key, "left")
    after = {c: F.col(f"_new.{c}") if c in carried else F.col(f"before.{c}") for c in columns if c != key}
    if "updated_at" in columns:
        after["updated_at"] = now
    rows = both.select(key, "before", *[v.alias(c) for c, v in after.items()])
    rows = rows.withColumn(HASH, content_hash([c for c in columns if c not in (key, *stamps)]))
    same = F.col(HASH) == F.col(f"before.{HASH}")
    change = F.when(F.col("before").isNull(), INSERTED).when(same, UNCHANGED).otherwise(UPDATED)
    # Field types as stored, so that before and after are the same struct.
    row = F.struct(*[F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    return rows.select(
        key, change.alias("change"), "before",
        F.when(change == UNCHANGED, F.col("before")).otherwise(row).alias("after"))


def apply_changes(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after the changes, hash column included."""
    written = changes.filter(F.col("change") != UNCHANGED)
    return base.join(written.select(key), key, "left_anti").unionByName(written.select("after.*"))


def count_deltas(changes: DataFrame, *columns: str) -> DataFrame:
    """columns, delta: what the changes do to the number of rows per value; one pass over the changes."""
    moved = changes.filter(F.col("change") != UNCHANGED)
    side = [F.struct(F.struct(*[F.col(f"{s}.{c}").alias(c) for c in columns]).alias("v"),
                     F.lit(n).cast("long").alias("n"), F.col(s).isNotNull().alias("there"))
            for s, n in (("before", -1), ("after", 1))]
    rows = moved.select(F.explode(F.array(*side)).alias("x")).filter("x.there")
    return rows.groupBy(*[F.col(f"x.v.{c}").alias(c) for c in columns]).agg(F.sum("x.n").alias("delta")).filter("delta <> 0")


def apply_deltas(counts: DataFrame, deltas: DataFrame, *columns: str) -> DataFrame:
    """Stored counts (columns, total) after the deltas; values that no row has any more leave."""
    both = counts.select(*columns, "total").unionByName(deltas.select(*columns, F.col("delta").alias("total")))
    return both.groupBy(*columns).agg(F.sum("total").alias("total")).filter("total <> 0")

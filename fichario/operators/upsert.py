"""Upserts without a table format: latest row per key (W2) and merges S10-S14.

A merge returns the new table; the caller writes it to a new path. Nothing reads and overwrites
the same files, so a lost executor or a repeated attempt cannot damage a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Of the rows sharing a key keep the last in ``order``.

    Spark applies the rank limit before the shuffle as well (window group limit), so a key that
    holds a third of all rows sends one row per task, not its whole group.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    )


def merge_latest(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    *,
    now: Column | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Updates replace base rows of the same key; no base row is ever deleted.

    ``now`` stamps ``updated_at`` of the updates. ``order`` dedupes updates first (W2).
    Known rows keep the columns that the updates do not carry; columns that only the updates have
    are NULL in the rows they do not touch (schema evolution).
    """
    # The keys alone decide which base rows stay, so duplicates need no dropping on this side.
    untouched = base.join(updates.select(key), key, "left_anti")
    if order:
        updates = latest_per_key(updates, key, order)
    if now is not None:
        updates = updates.withColumn("updated_at", now)
    kept = [c for c in base.columns if c not in updates.columns]
    if kept:
        updates = updates.join(base.select(key, *kept), key, "left")
    return untouched.unionByName(updates, allowMissingColumns=True)


def merge_lookup(
    base: DataFrame, updates: DataFrame, order: list[str] | None = None
) -> DataFrame:
    """Lookup upsert; only the description changes."""
    return merge_latest(
        base.select("codigo", "descricao"),
        updates.select("codigo", "descricao", *(order or [])),
        "codigo",
        order=order,
    ).select("codigo", "descricao")


def merge_enrichment(state: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Enrichment upsert; the columns of ``results`` are replaced, the others kept, time stamps
    refreshed, marks cleared."""
    stamped = results.withColumns(
        {
            "enriched_at": now,
            "updated_at": now,
            "processing_run_id": F.lit(None).cast("bigint"),
            "processing_started_at": F.lit(None).cast("timestamp"),
        }
    )
    return merge_latest(state, stamped, "cnpj")


def merge_qualification(history: DataFrame, evaluated: DataFrame, now: Column) -> DataFrame:
    """Qualification upsert.

    The root of a known row is not updated, and its ``qualified_at`` moves only when the new
    status is ``qualified``. Columns that only the history has stay. Both sides are unique per branch
    key, so the outer join cannot skew.
    """
    names = [c for c in evaluated.columns if c != "cnpj"]
    old, new = history.alias("old"), evaluated.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, F.col("old.cnpj") == F.col("new.cnpj"), "full_outer")
    changed = F.col("new._new").isNotNull()
    known = F.col("old.cnpj").isNotNull()
    qualified_at = (
        F.when(~changed, F.col("old.qualified_at"))
        .when(known & (F.col("new.qualification_status") != "qualified"), F.col("old.qualified_at"))
        .otherwise(now)
    )
    columns = [F.coalesce("new.cnpj", "old.cnpj").alias("cnpj")]
    for name in names:
        if name == "cnpj_basico":
            columns.append(F.coalesce("old.cnpj_basico", "new.cnpj_basico").alias(name))
        else:
            before = F.col(f"old.{name}") if name in history.columns else F.lit(None)
            columns.append(F.when(changed, F.col(f"new.{name}")).otherwise(before).alias(name))
    dates = ("qualified_at", "last_qualified_at", "updated_at")
    only_old = [c for c in history.columns if c not in (*evaluated.columns, *dates)]
    columns += [F.col(f"old.{c}").alias(c) for c in only_old]
    stamp = {n: F.when(changed, now).otherwise(F.col(f"old.{n}")) for n in
             ("last_qualified_at", "updated_at")}
    return joined.select(
        *columns, qualified_at.alias("qualified_at"), *[c.alias(n) for n, c in stamp.items()]
    )

"""Release load: plan -> read -> clean -> filter -> merge -> audit, per dataset kind.

The branch file decides what is kept; company, partner and simples rows follow the stored
branches (not only those of this run), so unchanged branch files may be skipped safely.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.functions.text import clean_text
from fichario.operators import filters, upsert
from fichario.operators.clean import clean_rows
from fichario.schemas import DATASETS

# Rows of one release are ordered by file and place in the file; the last one wins.
RELEASE_ORDER = ["file_name", "block_start", "row_id"]


@dataclass
class LoadResult:
    table: DataFrame
    report: DataFrame


def load_dataset(
    kind: str,
    raw: DataFrame,
    stored: DataFrame | None,
    competence: str,
    now: Column,
    rules: filters.BranchFilter | None = None,
    population: DataFrame | None = None,
    branches: DataFrame | None = None,
    hot_roots: list[str] | None = None,
) -> LoadResult:
    """Load the raw rows of one dataset into its table.

    ``raw`` comes from ``read_delimited`` or ``read_zipped``. ``branches`` is the stored branch
    table that company, partner and simples rows follow; ``hot_roots`` the roots that have very many of
    these rows, where they are known: if there are none, nothing is counted. Nothing is written here: save
    ``result.table`` to a new path, then ``result.report``.
    """
    dataset = DATASETS[kind]
    order = [c for c in RELEASE_ORDER if c in raw.columns]
    filtered = rules is not None and bool(rules.cnaes)
    if filtered and dataset.key != "cnpj" and not dataset.is_lookup and branches is not None:
        # Rows move by their root as they came and are cleaned where they meet it: no hash of a row is moved or
        # made in vain, and the rows of an id lie together by then.
        identity = [*order, *dataset.columns]
        named = raw.withColumn("cnpj_basico", clean_text(F.col("cnpj_basico")))
        followed = filters.follow_branches(named, branches, identity, hot=hot_roots)
        rows = clean_rows(followed.withColumn("_root", F.col("cnpj_basico")), kind, competence)
        rows = rows.withColumn("cnpj_basico", F.col("_root")).drop("_root")
    else:
        rows = clean_rows(raw, kind, competence)
    kept = rows
    if filtered:
        if dataset.key == "cnpj":
            kept = filters.filter_branches(rows, rules, population)
        elif kind == "Cnaes":
            kept = filters.restrict_lookup(rows, rules.cnaes)
    report = kept.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_processed"))
    columns = [*dataset.columns, *({dataset.key} - set(dataset.columns)), *order]
    if dataset.is_lookup:
        updates = kept.select(*columns)
        table = (
            upsert.latest_per_key(updates, "codigo", order)
            if stored is None
            else upsert.merge_lookup(stored, updates, order)
        )
    else:
        updates = kept.select(*columns, "source_competence")
        # An id is a hash of the row's columns, the root among them: rows that lie by it need no move for their id.
        key = ["cnpj_basico", "id"] if dataset.key == "id" else dataset.key
        latest = upsert.latest_per_key(updates, key, order).withColumn("updated_at", now)
        table = latest if stored is None else upsert.merge_latest(stored, latest, dataset.key)
    return LoadResult(table.drop(*order), report)


def company_tables(loaded: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Loaded tables by table name, as the views expect them."""
    return {DATASETS[kind].table: table for kind, table in loaded.items()}

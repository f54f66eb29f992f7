"""Load filters F1-F9 and the acceptance report F11."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions import registry as R
from fichario.operators import by_root, skew
from fichario.operators.by_root import ByRoot


@dataclass(frozen=True)
class BranchFilter:
    """Which branches a load keeps. Empty sets and zero floors switch a rule off."""

    cnaes: tuple[str, ...] = K.RETAIL_CNAES
    active_only: bool = True
    states: tuple[str, ...] = ()
    secondary_cnaes: bool = False
    require_trade_name: bool = False
    require_phone: bool = False
    min_population: int = 0


def is_active() -> Column:
    """a plain equality, so that it reaches the scan; NULL where the status is missing."""
    return F.col("situacao_cadastral") == K.ACTIVE_STATUS


def in_states(states) -> Column:
    """F2."""
    return R.state_code(F.col("uf")).isin(*[s.upper() for s in states])


def in_cnaes(cnaes, with_secondary: bool = False) -> Column:
    """main activity in the set, or any secondary one when asked for."""
    main = R.normalize_cnae(F.col("cnae_fiscal_principal")).isin(*cnaes)
    if not with_secondary:
        return main
    codes = F.array(*[F.lit(c) for c in cnaes])
    return main | F.arrays_overlap(R.secondary_cnaes(F.col("cnaes_fiscais_secundarios")), codes)


def is_retail() -> Column:
    """stored main activity is one of the retail codes."""
    return F.col("cnae_fiscal_principal").isin(*K.RETAIL_CNAES)


def branch_condition(rules: BranchFilter) -> Column:
    """The row rules of F7 (all but the city floor, which is a join)."""
    conditions = [F.lit(True)]
    if rules.active_only:
        conditions.append(is_active())
    if rules.states:
        conditions.append(in_states(rules.states))
    if rules.require_trade_name:
        conditions.append(R.has_trade_name(F.col("nome_fantasia")))
    if rules.require_phone:
        conditions.append(R.has_valid_phone(F.col("ddd1"), F.col("telefone1")))
    if rules.cnaes:
        conditions.append(in_cnaes(rules.cnaes, rules.secondary_cnaes))
    return reduce(lambda a, b: a & b, conditions)


def in_large_cities(branches: DataFrame, population: DataFrame, floor: int) -> DataFrame:
    """semi join with the cities at or above the floor, on (state, padded city code).

    The city table is small by nature; Spark broadcasts it by its measured size and falls back to
    a shuffled join beyond the threshold, so no hint is set.
    """
    cities = population.filter(F.col("populacao") >= floor).select(
        F.col("uf").alias("_uf"), F.col("codigo").alias("_codigo")
    )
    on = (R.state_code(branches["uf"]) == F.col("_uf")) & (
        R.city_code(branches["municipio"]) == F.col("_codigo")
    )
    return branches.join(cities, on, "left_semi")


def filter_branches(
    branches: DataFrame, rules: BranchFilter, population: DataFrame | None = None
) -> DataFrame:
    """all branch rules together."""
    kept = branches.filter(branch_condition(rules))
    if rules.min_population > 0:
        if population is None or population.isEmpty():
            raise ValueError("a population floor needs a loaded population table")
        kept = in_large_cities(kept, population, rules.min_population)
    return kept


def follow_branches(
    rows: DataFrame, branches: DataFrame, identity: list[str], hot_rows: int = skew.HOT_ROWS,
    hot: list[str] | None = None,
) -> DataFrame:
    """F8: keep company, partner and simples rows whose root has an accepted branch.

    The root set is made distinct first; a root with very many rows is spread (see ``skew``). Where the
    caller has found that there is none (``hot`` is empty, see ``by_root.hot_roots``), nothing is counted or
    salted, and what is kept lies by its root.
    """
    roots = branches.select("cnpj_basico").filter(F.col("cnpj_basico") != "").distinct()
    if hot is not None and not hot:
        return rows.join(roots, "cnpj_basico", "left_semi")
    return skew.spread_join(
        rows, roots, "cnpj_basico", identity, "left_semi", hot_rows=hot_rows
    )


def follow_stored(rows: ByRoot, branches: ByRoot) -> DataFrame:
    """F8 over tables stored by root: no shuffle, no counts."""
    named = branches.map(lambda part: part.select("cnpj_basico").filter(F.col("cnpj_basico") != ""))
    return by_root.join(rows, named, "left_semi").all()


def restrict_lookup(lookup: DataFrame, cnaes) -> DataFrame:
    """activity lookup limited to the wanted codes."""
    return lookup.filter(R.normalize_cnae(F.col("codigo")).isin(*cnaes))


def acceptance_report(scanned: DataFrame, kept: Column, file_column: str) -> DataFrame:
    """scanned, kept, skipped, match rate and distinct companies per file.

    Rows are first counted per (file, company): a hot file or company shrinks to one row per task
    before anything is shuffled, and the distinct count needs no second pass.
    """
    per_company = (
        scanned.withColumn("_kept", F.coalesce(kept, F.lit(False)).cast("int"))
        .groupBy(F.col(file_column), F.col("cnpj_basico"))
        .agg(F.count(F.lit(1)).alias("_scanned"), F.sum("_kept").alias("_kept"))
    )
    totals = per_company.groupBy(file_column).agg(
        F.sum("_scanned").alias("lidas"),
        F.sum("_kept").alias("gravadas"),
        F.count_if((F.col("_kept") > 0) & (F.col("cnpj_basico") != "")).alias("empresas_unicas"),
    )
    return totals.select(
        file_column,
        "lidas",
        "gravadas",
        (F.col("lidas") - F.col("gravadas")).alias("ignoradas"),
        (F.col("gravadas") * 100.0 / F.col("lidas")).alias("taxa"),
        "empresas_unicas",
    )

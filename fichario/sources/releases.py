"""Release listings: file kind (S4), newest release (S5), files to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.schemas import DATASETS

# Fixed value: a release month inside a folder or file name.
RELEASE_PATTERN = r"(20\d{2}-(?:0[1-9]|1[0-2]))"


def file_kind(name: Column) -> Column:
    """First dataset kind contained in the name, ignoring case; NULL when unknown."""
    lower = F.lower(name)
    rule = F
    for kind in DATASETS:
        rule = rule.when(F.contains(lower, F.lit(kind.lower())), kind)
    return rule.otherwise(F.lit(None))


def known_files(listing: DataFrame) -> DataFrame:
    """The ZIP files of a listing with a known kind."""
    return listing.withColumn("file_type", file_kind(F.col("name"))).filter(
        F.col("file_type").isNotNull() & F.endswith(F.lower("name"), F.lit(".zip"))
    )


def release_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, RELEASE_PATTERN, 1), F.lit(""))


def latest_release(listing: DataFrame, column: str = "competence") -> DataFrame:
    """The newest release month found, as a one-row table; no month at all is an error."""
    newest = listing.agg(F.max(release_of(F.col(column))).alias("competence"))
    return newest.select(
        F.coalesce(
            "competence", F.raise_error(F.lit("no release month YYYY-MM found")).cast("string")
        ).alias("competence")
    )


def files_to_load(
    listing: DataFrame, audit: DataFrame, kinds=(), force: bool = False
) -> DataFrame:
    """Known files that are new or changed since their last successful load.

    Unknown remote size or date does not count as a change. ``kinds`` restricts the datasets.
    """
    files = known_files(listing)
    if kinds:
        files = files.filter(F.col("file_type").isin(*kinds))
    if force:
        return files
    done = audit.filter(F.col("status") == "success").select(
        F.col("competence"),
        F.col("file_name").alias("name"),
        F.col("source_size").alias("_size"),
        F.col("source_last_modified").alias("_modified"),
        F.lit(True).alias("_done"),
    )
    same_size = F.col("size").isNull() | F.col("size").eqNullSafe(F.col("_size"))
    same_date = F.col("last_modified").isNull() | F.col("last_modified").eqNullSafe(
        F.col("_modified")
    )
    unchanged = F.col("_done").isNotNull() & same_size & same_date
    return (
        files.join(done, ["competence", "name"], "left")
        .filter(~unchanged)
        .drop("_size", "_modified", "_done")
    )

"""Queue and retry jobs R1-R5 and the keyset batch L4. ``now`` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario import constants as K


def pending(
    queue: DataFrame, now: Column, version: str = K.ENRICHMENT_VERSION, force: bool = False
) -> DataFrame:
    """Rows of J7 that are due for enrichment; ``force`` takes every candidate."""
    if force:
        return queue
    due = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)
    wanted = (
        F.col("has_state").isNull()
        | ~F.col("enrichment_version").eqNullSafe(F.lit(version))
        | (F.col("enrich_status") == "pending")
        | (F.col("enrich_status").isin("failed", "no_site") & due)
    )
    stale_mark = F.col("processing_started_at") < now - F.expr("interval 2 hours")
    free = F.col("processing_run_id").isNull() | stale_mark
    return queue.filter(wanted & free)


def keyset_batch(
    queue: DataFrame, limit: int, after: str | None = None, exclude: DataFrame | None = None
) -> DataFrame:
    """L4: the next ``limit`` rows in key order after ``after``, without excluded keys."""
    rows = queue if after is None else queue.filter(F.col("cnpj") > after)
    if exclude is not None:
        rows = rows.join(exclude.select("cnpj"), "cnpj", "left_anti")
    return rows.orderBy("cnpj").limit(limit)


def next_retry(
    rows: DataFrame,
    now: Column,
    no_site_days: int = K.NO_SITE_RETRY_DAYS,
    failed_hours: int = K.FAILED_RETRY_HOURS,
) -> DataFrame:
    """R2: when to try again; NULL when there is no reason to."""
    days, hours = F.col("retry_after_days"), F.col("retry_after_hours")

    def later(d=0, h=0) -> Column:
        as_column = [F.lit(v) if isinstance(v, int) else v for v in (d, h)]
        return now + F.make_interval(days=as_column[0], hours=as_column[1])

    when = (
        F.when(F.col("retry_reason") == "google_places_no_result", later(d=K.PLACE_TTL_DAYS))
        .when(F.coalesce(days, F.lit(0)) != 0, later(d=days))
        .when(F.coalesce(hours, F.lit(0)) != 0, later(h=hours))
        .when(F.col("enrich_status") == "no_site", later(d=no_site_days))
        .when(F.col("enrich_status") == "failed", later(h=failed_hours))
    )
    return rows.withColumn("next_retry_at", when)


def requeue(
    state: DataFrame, now: Column, reason: str = "version_upgrade", target: str = "v2"
) -> DataFrame:
    """Rows of another enrichment or score version go back to the queue.

    Returns the whole state with a ``requeued`` flag; its count is the number of rows changed.
    """
    other = ~F.col("enrichment_version").eqNullSafe(F.lit(target)) | ~F.col(
        "score_version"
    ).eqNullSafe(F.lit(target))
    finished = F.col("enrich_status").isin("done", "partial")
    marked = state.withColumn("requeued", other)
    changed = F.col("requeued")
    return marked.withColumns(
        {
            "next_retry_at": F.when(changed, now).otherwise(F.col("next_retry_at")),
            "retry_reason": F.when(changed, F.lit(reason)).otherwise(F.col("retry_reason")),
            "enrich_status": F.when(changed & finished, "pending").otherwise(F.col("enrich_status")),
            "enrichment_version": F.when(~changed, F.col("enrichment_version")),
        }
    )


def count_attempt(rows: DataFrame) -> DataFrame:
    """One more attempt."""
    return rows.withColumn("enrich_attempts", F.coalesce(F.col("enrich_attempts"), F.lit(0)) + 1)


def place_is_cached(now: Column, ttl_days: int = K.PLACE_TTL_DAYS) -> Column:
    """A place found before is reused while its check is younger than ``ttl_days``."""
    fresh = F.col("google_places_checked_at") > now - F.make_interval(days=F.lit(ttl_days))
    return F.coalesce(fresh, F.lit(False)) & (
        F.coalesce(F.col("google_place_id"), F.lit("")) != ""
    )

"""Incremental load of arriving release files as a file stream.

Each micro-batch appends its cleaned rows under ``batch=<id>`` of a log; the current table is the
latest row per key over the log (merge on read). Appending costs the size of the new files only,
whereas rewriting the table per batch would cost the size of all history. A repeated batch writes
the same folder again, so a restart after a lost executor adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fichario.operators.clean import clean_rows
from fichario.operators.upsert import latest_per_key
from fichario.schemas import DATASETS
from fichario.sources.registry_files import ENCODING, QUOTE, SEPARATOR
from fichario.sources.releases import release_of

LOG_ORDER = ["source_competence", "file_name", "block_start", "row_id"]


def start_ingest(
    spark: SparkSession,
    kind: str,
    incoming: str,
    log_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    keep=None,
) -> StreamingQuery:
    """Load every file not seen before, then stop. ``keep`` filters each cleaned batch."""
    stream = (
        spark.readStream.schema(DATASETS[kind].raw_schema)
        .option("sep", SEPARATOR)
        .option("quote", QUOTE)
        .option("escape", QUOTE)
        .option("encoding", ENCODING)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    rows = stream.csv(incoming).select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        release_of(F.col("_metadata.file_path")).alias("source_competence"),
    )
    cleaned = clean_rows(rows, kind)

    def append(batch: DataFrame, batch_id: int) -> None:
        kept = batch if keep is None else keep(batch)
        numbered = kept.withColumn("row_id", F.monotonically_increasing_id())
        numbered.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    return (
        cleaned.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_table(spark: SparkSession, kind: str, log_path: str) -> DataFrame:
    """The table as of all batches so far: the latest row per key."""
    dataset = DATASETS[kind]
    log = spark.read.parquet(log_path)
    return latest_per_key(log, dataset.key, LOG_ORDER).drop(
        "batch", "file_name", "block_start", "row_id"
    )

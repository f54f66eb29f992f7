"""Delimited registry files (S1) and zipped snapshots."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from itertools import islice, zip_longest

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fichario.schemas import DATASETS

# Format of the release files.
SEPARATOR, QUOTE, ENCODING = ";", '"', "ISO-8859-1"

_BATCH_ROWS = 20_000


def read_delimited(
    spark: SparkSession, paths: str | list[str], kind: str, multi_line: bool = True
) -> DataFrame:
    """Latin-1, ``;``-separated, headerless rows as text columns, with file and position.

    Short rows are padded with NULL and extra fields dropped. ``multi_line`` allows line breaks
    inside quoted fields, at the price of one task per file; set it to False for releases known
    to have none, and large files are split. ``ranges.read_ranges`` splits both.
    """
    rows = (
        spark.read.schema(DATASETS[kind].raw_schema)
        .option("sep", SEPARATOR)
        .option("quote", QUOTE)
        .option("escape", QUOTE)
        .option("encoding", ENCODING)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("file_name"),
        # Order inside a file: start of the split, then the running id inside the task.
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def write_delimited(rows: DataFrame, kind: str, path: str) -> None:
    """Write text columns in the release format (for tests and data exchange)."""
    rows.select(*DATASETS[kind].columns).write.option("sep", SEPARATOR).option(
        "quote", QUOTE
    ).option("escape", QUOTE).option("encoding", ENCODING).option("quoteAll", True).option(
        "emptyValue", ""
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _uri(path: str) -> str:
    """Paths as Arrow wants them; ``file:/x`` is how Spark writes a local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return path if "://" in path else "file://" + path


def open_input(path: str):
    """Seekable input stream on any file system Arrow knows (local, HDFS, object stores)."""
    system, inner = fs.FileSystem.from_uri(_uri(path))
    return system.open_input_file(inner)


def _snapshot_rows(path: str) -> Iterator[list[str]]:
    """Rows of the first file in a ZIP, decompressed as a stream."""
    with open_input(path) as source, zipfile.ZipFile(source) as archive:
        members = [m for m in archive.infolist() if not m.is_dir()]
        if not members:
            raise ValueError(f"ZIP without files: {path}")
        with archive.open(members[0]) as raw:
            text = io.TextIOWrapper(raw, encoding=ENCODING, newline="")
            yield from csv.reader(text, delimiter=SEPARATOR, quotechar=QUOTE)


def read_zipped(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """Rows of zipped snapshots.

    Compressed data cannot be split, so each ZIP is one task that streams it in batches and holds
    only one batch in memory. The rows are redistributed right after, so a large ZIP weighs on
    reading alone. ``row_id`` is the exact row number inside the ZIP.
    """
    columns = DATASETS[kind].columns
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in columns]
        + [T.StructField("source_path", T.StringType()), T.StructField("row_id", T.LongType())]
    )

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(columns)
        for batch in batches:
            for path in (paths[i] for i in batch.column(0).to_pylist()):
                rows, start = _snapshot_rows(path), 0
                while chunk := list(islice(rows, _BATCH_ROWS)):
                    values = list(islice(zip_longest(*chunk, fillvalue=""), width))
                    values += [("",) * len(chunk)] * (width - len(values))
                    arrays = [pa.array(column, pa.string()) for column in values]
                    arrays.append(pa.array([path] * len(chunk), pa.string()))
                    arrays.append(pa.array(range(start, start + len(chunk)), pa.int64()))
                    start += len(chunk)
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    # One range row per file in as many partitions: exactly one task per ZIP. (A shuffle of the
    # short path list would be merged into a single task by adaptive execution.)
    rows = spark.range(0, len(paths), 1, max(1, len(paths))).mapInArrow(expand, schema)
    return rows.withColumn(
        "file_name", F.regexp_extract("source_path", "([^/]+)$", 1)
    ).repartition(F.col("source_path"), F.pmod(F.col("row_id"), F.lit(1024)))


def write_zipped(rows: DataFrame, kind: str, folder: str, file_prefix: str) -> DataFrame:
    """Write text columns as ZIP files, one per task; returns their paths.

    File names depend on the partition number only, so a repeated task replaces its own file.
    """
    columns = list(DATASETS[kind].columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        uri = _uri(f"{folder}/{file_prefix}{part}.zip")
        system, inner = fs.FileSystem.from_uri(uri)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(inner) as sink, zipfile.ZipFile(
            sink, "w", zipfile.ZIP_DEFLATED
        ) as archive, archive.open(f"{file_prefix}{part}.csv", "w") as member:
            text = io.TextIOWrapper(member, encoding=ENCODING, newline="")
            writer = csv.writer(
                text, delimiter=SEPARATOR, quotechar=QUOTE, quoting=csv.QUOTE_ALL,
                lineterminator="\n",
            )
            for batch in batches:
                writer.writerows(zip(*[column.to_pylist() for column in batch.columns]))
            text.flush()
        yield pa.RecordBatch.from_pydict({"source_path": [uri]})

    return rows.select(*columns).mapInArrow(pack, "source_path string")

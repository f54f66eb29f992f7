"""Split reading of delimited files whose quoted fields may hold line breaks.

Whether a line break ends a row depends on all quotes before it, so a file can't simply be cut. Each
byte range is first reduced to what it does to a reader: a map from the five states a reader may be in
before the range to the state behind it. Maps are composed along each file (a prefix pass over one small
row per range), which gives the true state at every cut. Then every range is read by itself: it owns
the rows that start in it, and reads the last one to its end.

The maps of single bytes generate a small monoid under composition, so a range's map is found by
numpy: bytes to elements, then neighbours composed pairwise by a table until one is left.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fichario.schemas import DATASETS
from fichario.sources.registry_files import ENCODING, QUOTE, SEPARATOR, open_input

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
BATCH_ROWS = 20_000
# States of a reader, by what comes next: the start of a row or field, more of an unquoted or quoted
# field, or the byte behind a quote that may close its field.
ROW, FIELD, PLAIN, QUOTED, CLOSING = range(5)
OTHER, MARK, CUT, END = range(4)  # kinds of bytes: any, quote, separator, line break

# What a byte of each kind does to each state.
STEP = {
    OTHER: (PLAIN, PLAIN, PLAIN, QUOTED, PLAIN),
    MARK: (QUOTED, QUOTED, PLAIN, CLOSING, QUOTED),
    CUT: (FIELD, FIELD, FIELD, QUOTED, FIELD),
    END: (ROW, ROW, ROW, QUOTED, ROW),
}


def _monoid() -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All maps that bytes can compose to, those of the single kinds first, and their composition."""
    maps = [STEP[kind] for kind in (OTHER, MARK, CUT, END)]
    maps.append(tuple(range(5)))
    known = {m: n for n, m in reversed(list(enumerate(maps)))}
    for first in maps:  # grows as new maps are met
        for step in list(STEP.values()):
            both = tuple(step[state] for state in first)
            if both not in known:
                known[both] = len(maps)
                maps.append(both)
    table = np.array([[known[tuple(b[s] for s in a)] for b in maps] for a in maps], np.uint8)
    return maps, table


MAPS, COMPOSED = _monoid()
NOTHING = 4  # the map that changes no state
_KINDS = np.zeros(256, np.uint8)
_KINDS[ord(QUOTE)], _KINDS[ord(SEPARATOR)], _KINDS[ord("\n")], _KINDS[ord("\r")] = MARK, CUT, END, END


def effect(data: bytes) -> int:
    """Number of the map of a block of bytes."""
    found = _KINDS[np.frombuffer(data, np.uint8)]
    while len(found) > 1:
        odd = found[-1:] if len(found) % 2 else found[:0]
        even = len(found) // 2 * 2
        found = np.concatenate([COMPOSED[found[:even:2], found[1:even:2]], odd])
    return int(found[0]) if len(found) else NOTHING


def first_row(path: str, at: int, state: int, size: int) -> int:
    """Where the first row at or behind a place starts, given the state there; the size if none does."""
    with open_input(path) as source:
        source.seek(at)
        while at < size:
            block = source.read(min(BLOCK_BYTES, size - at))
            for n, kind in enumerate(_KINDS[np.frombuffer(block, np.uint8)].tolist()):
                if state == ROW:
                    return at + n
                state = STEP[kind][state]
            at += len(block)
    return size


class _Part(io.RawIOBase):
    """Bytes of a file from one place to another, as a stream."""

    def __init__(self, source, begin: int, end: int):
        source.seek(begin)
        self.source, self.left = source, end - begin

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.source.read(min(len(buffer), self.left))
        buffer[:len(data)] = data
        self.left -= len(data)
        return len(data)


def rows_between(path: str, begin: int, end: int) -> Iterator[list[str | None]]:
    """Rows of the bytes between two row starts; an unquoted empty field is None. Streams."""
    csv.field_size_limit(1 << 30)
    with open_input(path) as source:
        part = io.BufferedReader(_Part(source, begin, end), BLOCK_BYTES)
        text = io.TextIOWrapper(part, encoding=ENCODING, newline="")
        for row in csv.reader(text, delimiter=SEPARATOR, quotechar=QUOTE, quoting=csv.QUOTE_NOTNULL):
            if row:
                yield row


class Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int, size: int, state: int, after: int):
        self.path, self.begin, self.end, self.size = path, begin, end, size
        self.state, self.after = state, after  # at begin and at end


class RangeReader(DataSourceReader):
    def __init__(self, columns: list[str], ranges: list[list]):
        self.columns, self.ranges = columns, ranges

    def partitions(self) -> list[Range]:
        return [Range(*r) for r in self.ranges]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        begin = first_row(partition.path, partition.begin, partition.state, partition.size)
        end = first_row(partition.path, partition.end, partition.after, partition.size)
        width, held, start = len(self.columns), [], 0

        def batch() -> pa.RecordBatch:
            values = list(zip_longest(*held, fillvalue=None))[:width]
            values += [(None,) * len(held)] * (width - len(values))
            arrays = [pa.array(column, pa.string()) for column in values]
            arrays += [pa.array([partition.path] * len(held), pa.string()),
                       pa.array([partition.begin] * len(held), pa.int64()),
                       pa.array(range(start, start + len(held)), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=[*self.columns, "source_path", "block_start", "row_id"])

        for row in rows_between(partition.path, begin, end) if begin < end else ():
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield batch()
                start, held = start + len(held), []
        if held:
            yield batch()


class RegistryRanges(DataSource):
    """Python data source: one partition per range. Options: kind, and ranges as JSON rows
    [path, begin, end, size, state at begin, state at end]."""

    @classmethod
    def name(cls) -> str:
        return "registry_ranges"

    def schema(self) -> T.StructType:
        columns = [T.StructField(c, T.StringType()) for c in DATASETS[self.options["kind"]].columns]
        places = [T.StructField("block_start", T.LongType()), T.StructField("row_id", T.LongType())]
        return T.StructType([*columns, T.StructField("source_path", T.StringType()), *places])

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(list(DATASETS[self.options["kind"]].columns), json.loads(self.options["ranges"]))


def cut_ranges(sizes: list[tuple[str, int]], range_bytes: int) -> list[tuple[str, int, int, int]]:
    """(path, begin, end, size) of all ranges, in order; an empty file has none."""
    return [(path, at, min(size, at + range_bytes), size)
            for path, size in sorted(sizes) for at in range(0, size, range_bytes)]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, begin, end in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "end"))):
            with open_input(path) as source:
                source.seek(begin)
                whole = NOTHING
                while begin < end:
                    block = source.read(min(BLOCK_BYTES, end - begin))
                    whole, begin = int(COMPOSED[whole, effect(block)]), begin + len(block)
            found.append(whole)
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("begin"), pa.array(found, pa.int32())], names=["path", "begin", "map"])


def read_ranges(
    spark: SparkSession, paths: str | list[str], kind: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Rows of delimited files (Latin-1, ``;``, headerless) as text columns, with file and position.

    Files are cut into ranges of `range_bytes`; each is a task, whatever line breaks its quoted fields
    hold. Short rows are padded with NULL, extra fields dropped, empty rows skipped. A file of one range
    is read once; files of several are read twice (states, then rows). Only one row per range meets in
    the driver. Order inside a file: `block_start`, then `row_id`.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length")
    ranges = cut_ranges([(row.path, row.length) for row in listed.collect()], range_bytes)
    several = [r[:3] for r in ranges if r[3] > range_bytes]
    states = {(path, begin): ROW for path, begin, _, _ in ranges if begin == 0}
    if several:
        cuts = spark.createDataFrame(several, "path string, begin long, end long").repartition(len(several), "path", "begin")
        maps = {(r.path, r.begin): r.map for r in cuts.mapInArrow(_effects, "path string, begin long, map int").collect()}
        for path, begin, end, _ in ranges:
            if (path, begin) in maps:
                states[path, end] = MAPS[maps[path, begin]][states[path, begin]]
    spark.dataSource.register(RegistryRanges)
    rows = spark.read.format("registry_ranges").option("kind", kind).option("ranges", json.dumps(
        [[path, begin, end, size, states[path, begin], states.get((path, end), ROW)]
         for path, begin, end, size in ranges])).load()
    return rows.select("*", F.regexp_extract("source_path", "([^/]+)$", 1).alias("file_name"))

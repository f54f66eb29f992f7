"""WARC archives as seekable zstandard bundles.

Records are grouped into frames that unpack independently of each other. After the last frame comes
a skippable frame with the seek table of the public seekable format (compressed and plain size per
frame), so any zstandard reader unpacks a bundle and ours jumps to a frame. An index table maps every
page_id to its bundle, its frame and its place inside the unpacked frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import saved, small_batches
from fichario.llm.files import new_file, open_in, open_out
from fichario.session import new_folder

FRAME_BYTES = 1 << 20
FRAMES_OF_A_BUNDLE = 4_096
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"  # fixed, so that a repeated task writes the same bytes

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


INDEX = pa.schema([("page_id", pa.int64()), ("path", pa.string()), ("frame", pa.int64()), ("place", pa.int64())])
RECORD = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
FETCHED = pa.schema([
    ("want", pa.int64()), ("html", pa.string()), ("target", pa.int64()), ("digest", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header value cannot hold line breaks."""
    return (value or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit has the payload's size and digest but no block."""
    block = payload if refers_to is None else b""
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: memoryview, at: int) -> tuple[dict[str, str], memoryview, int]:
    """Headers and block of the record at a place, and where the next one begins."""
    view = bytes(data[at:at + 4096])
    end = view.find(b"\r\n\r\n")
    while end < 0:  # a very long target
        if len(view) >= len(data) - at:
            raise ValueError("record without end of headers")
        view = bytes(data[at:at + 2 * len(view)])
        end = view.find(b"\r\n\r\n")
    version, *lines = view[:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    begin = at + end + 4
    stop = begin + int(headers["Content-Length"])
    return headers, data[begin:stop], stop + 4


class Bundle:
    """Writes one bundle; keeps one frame in memory."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES):
        self.uri, self.out, self.limit = uri, open_out(uri), frame_bytes
        self.pack = zstandard.ZstdCompressor(LEVEL).compress
        self.held, self.size, self.frames = [], 0, []

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and place of the record."""
        if self.held and self.size + len(data) > self.limit:
            self._frame()
        place = (len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        return place

    def _frame(self) -> None:
        packed = self.pack(b"".join(self.held))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)
        self.out.close()


class Archive:
    """Reads frames of a bundle through its seek table."""

    def __init__(self, uri: str):
        self.file = open_in(uri)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table: {uri}")
        self.file.seek(size - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> memoryview:
        at, packed, plain = self.frames[number]
        self.file.seek(at)
        return memoryview(zstandard.ZstdDecompressor().decompress(self.file.read(packed), plain or 1))


def write(pages: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html); returns the index table.

    Index: page_id, path, frame, place. Null html is the empty payload. Of rows with equal payloads
    the smallest page_id is the response, others revisit it; rows that repeat that page_id are
    responses too, and rows without page_id are responses. Rows with one page_id but different
    payloads are told apart by their payload. No rows: no bundle, an empty index.
    """
    spark = pages.sparkSession
    small_batches(spark, 100)
    folder = new_folder(spark, "warc")
    marked = pages.select("page_id", "url", "html", _payload_hash().alias("d")).join(
        _revisits(pages), ["page_id", "d"], "left")

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                payload, target = (row["html"] or "").encode(), row["refers_to"]
                if bundle is not None and len(bundle.frames) >= FRAMES_OF_A_BUNDLE:
                    bundle.close()
                    bundle = None
                if bundle is None:
                    bundle = Bundle(new_file(folder, f"pages-{part:06d}", ".warc.zst"), frame_bytes)
                place = bundle.add(record(row["page_id"], row["url"], payload, target))
                rows.append((row["page_id"], bundle.uri, *place))
            yield _batch(rows, INDEX)
        if bundle is not None:
            bundle.close()

    return saved(
        marked.mapInArrow(write_part, "page_id long, path string, frame long, place long"), "warc-index")


def _payload_hash() -> Column:
    return F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))


def _revisits(pages: DataFrame) -> DataFrame:
    """page_id, d, refers_to of the pages that repeat the payload of a page with a smaller id. Only
    ids and digests are shuffled; the smallest id of a payload is found before its copies meet."""
    marks = saved(pages.select("page_id", _payload_hash().alias("d")), "digests")
    first = saved(
        marks.groupBy("d").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("c"))
        .filter("c > 1").drop("c"), "first-pages")
    later = marks.join(first, "d").filter("page_id > refers_to").distinct()
    return saved(later.select("page_id", "d", "refers_to"), "revisits")


def _number(mark: str | None) -> int | None:
    digits = (mark or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record, parsed
    from the bundles of an index; a response's digest is worked out again from what was read."""

    def read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                archive = Archive(uri)
                for n in range(len(archive.frames)):
                    data, at, rows = archive.frame(n), 0, []
                    while at < len(data):
                        headers, block, at = parse(data, at)
                        kind, own = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest(block) != own:
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                        rows.append((
                            _number(headers["WARC-Record-ID"]), int(headers["X-Payload-Length"]), own, kind,
                            _number(headers.get("WARC-Refers-To")), headers["WARC-Target-URI"]))
                    yield _batch(rows, RECORD)

    paths = saved(index.select("path").distinct(), "bundles")
    return paths.repartition(max(1, paths.count())).mapInArrow(
        read_frames, "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string")


def fetch(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """page_id, html of the wanted page_ids (page_id): one frame read per record, by the seek table.
    A revisit gives the payload of its response. Wanted ids that are not stored give no row."""

    def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                headers, block, _ = parse(Archive(row["path"]).frame(row["frame"]), row["place"])
                target = _number(headers.get("WARC-Refers-To"))
                html = bytes(block).decode() if target is None else None
                rows.append((row["want"], html, target, headers["WARC-Payload-Digest"]))
            yield _batch(rows, FETCHED)

    shape = "want long, html string, target long, digest string"
    found = saved(
        page_ids.select(F.col("page_id").alias("want")).distinct()
        .join(index, F.col("want") == F.col("page_id")).mapInArrow(read_records, shape), "records")
    more = found.filter("target is not null").select("want", "target", F.col("digest").alias("own"))
    more = more.join(
        more.select(F.col("target").alias("want")).distinct()
        .join(index, F.col("want") == F.col("page_id")).mapInArrow(read_records, shape)
        .select(F.col("want").alias("target"), "html", "digest"), "target").filter("own = digest")
    return found.filter("target is null").select(F.col("want").alias("page_id"), "html").unionByName(
        more.select(F.col("want").alias("page_id"), "html"))

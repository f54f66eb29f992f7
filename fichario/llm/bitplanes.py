"""Token ids in files of compressed planes.

Ids are cut into blocks of a fixed number. A block is transposed: byte plane k holds byte k of every
id (bit planes: bit k), so that the nearly constant high planes shrink to almost nothing; each plane
is one zstandard frame. File layout, little-endian:

    header   4s magic, u16 version, u8 planes per block, u8 unused, u32 ids per block
    blocks   the planes of each block, one after another
    documents  a zstandard frame: doc ids (i64), null marks (u8), lengths (u64)
    chunk index  per block: u64 offset, u32 ids, u32 length of each plane
    trailer  u64 offset of documents, u64 offset of the index, u64 documents, u64 ids, u64 blocks, 4s magic

Any range of ids is read through the index without touching other blocks. Writing and reading keep
one block in memory, and 17 bytes per document of the file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fichario.llm.common import arrow_batches, saved, text_key
from fichario.llm.files import new_file, open_in, open_out
from fichario.session import new_folder

MAGIC = b"BPLN"
HEADER, TRAILER = struct.Struct("<4sHBBI"), struct.Struct("<QQQQQ4s")
BLOCK_IDS = 65_536
LEVEL = 3
CACHED_WORDS = 800_000
CACHED_CHARS = 64
BATCH_BYTES = 4 << 20  # of texts that a task takes at once
MARK = "\ue000"  # a word of its own, for which the vocabulary has bytes only
# A word of Latin letters up to U+00FF: composed, one piece for the file's pattern.
LATIN_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
# The printable character that stands for each byte in byte-level vocabularies (a public rule).
SYMBOLS = {b: 256 + n for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
# A part that the library must see alone: names of special tokens, the mark itself.
ODD = re.compile(rb"<\||\xee\x80\x80").search
# A Latin letter, then one mark at the end of a part.
WORD_AND_MARK = re.compile(rb"(?s).*(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])[.,;:!?]").fullmatch


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """4 byte planes or 32 bit planes of uint32 ids."""
    table = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [table[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(parts: list[bytes], count: int) -> np.ndarray:
    if len(parts) == 4:
        table = np.empty((count, 4), np.uint8)
        for k, part in enumerate(parts):
            table[:, k] = np.frombuffer(part, np.uint8, count)
    else:
        bits = np.empty((count, 32), np.uint8)
        for k, part in enumerate(parts):
            bits[:, k] = np.unpackbits(np.frombuffer(part, np.uint8), count=count)
        table = np.packbits(bits, axis=1, bitorder="little")
    return table.reshape(-1).view("<u4")


class Writer:
    def __init__(self, uri: str, planes: int = 4, block: int = BLOCK_IDS):
        self.out, self.planes, self.block = open_out(uri), planes, block
        self.pack = zstandard.ZstdCompressor(LEVEL).compress
        self.held, self.count = [], 0
        self.at, self.index = 0, []
        self.docs: tuple[list[int], bytearray, list[int]] = ([], bytearray(), [])
        self._write(HEADER.pack(MAGIC, 1, planes, 0, block))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        parts = [self.pack(p) for p in to_planes(ids, self.planes)]
        self.index.append(struct.pack(f"<QI{self.planes}I", self.at, len(ids), *map(len, parts)))
        for part in parts:
            self._write(part)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs[0].append(doc_id or 0)
        self.docs[1].append(doc_id is None)
        self.docs[2].append(len(ids))
        self.held.append(ids)
        self.count += len(ids)
        if self.count >= self.block:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.block * self.block
            for low in range(0, whole, self.block):
                self._block(flat[low:low + self.block])
            self.held, self.count = [flat[whole:]], len(flat) - whole

    def close(self) -> tuple[int, int]:
        """Numbers of documents and ids."""
        if self.count:
            self._block(np.concatenate(self.held))
        numbers, nulls, lengths = self.docs
        docs = self.at
        self._write(self.pack(
            np.array(numbers, "<i8").tobytes() + bytes(nulls) + np.array(lengths, "<u8").tobytes()))
        index, total = self.at, int(sum(lengths))
        self._write(b"".join(self.index))
        self._write(TRAILER.pack(docs, index, len(numbers), total, len(self.index), MAGIC))
        self.out.close()
        return len(numbers), total


class Reader:
    def __init__(self, uri: str):
        self.file = open_in(uri)
        size = self.file.size()
        magic, version, self.planes, _, self.block = HEADER.unpack(self._read(0, HEADER.size))
        docs, index, self.n_docs, self.n_ids, blocks, end = TRAILER.unpack(
            self._read(size - TRAILER.size, TRAILER.size))
        if (magic, version, end) != (MAGIC, 1, MAGIC):
            raise ValueError(f"not a plane file: {uri}")
        self.docs_at, self.docs_size = docs, index - docs
        entry = struct.Struct(f"<QI{self.planes}I")
        self.index = list(entry.iter_unpack(self._read(index, blocks * entry.size)))
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, null marks and lengths of the documents in order."""
        data, n = self.unpack(self._read(self.docs_at, self.docs_size)), self.n_docs
        return (np.frombuffer(data, "<i8", n), np.frombuffer(data, np.uint8, n, 8 * n),
                np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64))

    def chunk(self, number: int) -> np.ndarray:
        at, count, *sizes = self.index[number]
        data, parts = memoryview(self._read(at, sum(sizes))), []
        for size in sizes:
            parts.append(self.unpack(data[:size]))
            data = data[size:]
        return from_planes(parts, count)

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Ids start .. start + count in pieces; reads the blocks that hold them, no other."""
        while count > 0:
            number, skip = divmod(start, self.block)
            piece = self.chunk(number)[skip:skip + count]
            yield piece
            start, count = start + len(piece), count - len(piece)


class Encoder:
    """Ids by the library, as bytes. The file's tokenizer drops white space, never merges over it and
    lowers case, so every part between spaces has ids of its own, and parts that return are not
    encoded again. It also never merges a letter with a mark behind it, so `word,` has the ids of
    `word` and of `,`. What is kept is bounded: when full, only parts that returned stay; long parts
    are never kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library, self.merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for one in (self.library, self.merges):
            one.no_truncation()
            one.no_padding()
        self.merges.normalizer, self.merges.pre_tokenizer = None, WhitespaceSplit()
        self.stop = np.array(self.merges.encode(".", add_special_tokens=False).ids, "<u4")
        self.mark = np.array(self.library.encode(MARK, add_special_tokens=False).ids, "<u4")
        self.known: dict[bytes, bytes] = {}
        self.returned: set[bytes] = set()

    @staticmethod
    def parts(text: str | None) -> list[bytes]:
        """Parts of a text, ASCII letters lowered (the library lowers the rest) where that changes nothing.

        A letter under a combining mark stays as it is: the library composes first, and some marks
        compose with the small letter only. Names of special tokens keep their case.
        """
        data = (text or "").encode()
        plain = b"<|" not in data
        if plain and b"\xcc" not in data and b"\xcd" not in data:  # first bytes of the marks U+0300 to U+036F
            return data.lower().replace(b"\n", b" ").split(b" ")
        found = data.replace(b"\n", b" ").split(b" ")
        return [p.lower() if p.isascii() else p for p in found] if plain else found

    def _cut(self, library, words: list[str], mark: str, size: np.ndarray) -> Iterator[bytes]:
        """Ids of every word by one call: a mark that no word holds shows where they end."""
        joined = library.encode_batch_fast([f" {mark} ".join(words)], add_special_tokens=False)
        ids, width = np.array(joined[0].ids, "<u4"), len(size)
        found = np.ones(max(0, len(ids) - width + 1), bool)
        for k, one in enumerate(size):
            found &= ids[k:len(ids) - width + 1 + k] == one
        ends, data = (np.flatnonzero(found) * 4).tolist(), ids.tobytes()
        return (data[begin:end] for begin, end in zip([0, *(e + 4 * width for e in ends)], [*ends, len(data)], strict=True))

    def _ask(self, missing: list[bytes]) -> None:
        """Latin words go to the merges as they are, in the symbols of their bytes; the rest takes the whole way."""
        latin = [p for p in missing if LATIN_WORD(p)]
        if latin:
            small = [p if p.isascii() else p.decode().lower().encode() for p in latin]
            words = [p.decode("latin-1").translate(SYMBOLS) for p in small]
            self.known.update(zip(latin, self._cut(self.merges, words, ".", self.stop)))
        rest = [p for p in missing if not LATIN_WORD(p)]
        plain = [p for p in rest if ODD(p) is None]
        if plain:
            self.known.update(zip(plain, self._cut(self.library, [p.decode() for p in plain], MARK, self.mark)))
        for part in rest:
            if ODD(part) is not None:
                found = self.library.encode(part.decode(), add_special_tokens=False)
                self.known[part] = np.array(found.ids, "<u4").tobytes()

    def _fill(self, missing: list[bytes]) -> list[bytes]:
        """Makes the missing parts known; gives all that became known."""
        ends = {part: part[:-1] for part in missing if WORD_AND_MARK(part)}
        plain = set(missing).difference(ends)
        plain.update(ends.values(), (part[-1:] for part in ends))
        plain = [part for part in plain if part not in self.known]
        if plain:
            self._ask(plain)
        known = self.known
        for part, stem in ends.items():
            known[part] = known[stem] + known[part[-1:]]
        return [*plain, *ends]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = list(map(self.parts, texts))
        wanted = set().union(*split)
        if len(self.known) > CACHED_WORDS:
            stay = self.returned if len(self.returned) < CACHED_WORDS // 2 else ()
            self.known = {part: self.known[part] for part in stay}
            self.returned = set()
        missing = wanted.difference(self.known)
        self.returned.update(wanted.difference(missing))
        fresh = self._fill(list(missing)) if missing else []
        look = self.known.__getitem__
        out = [b"".join(map(look, parts)) for parts in split]
        for part in fresh:
            if len(part) > CACHED_CHARS:
                del self.known[part]
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    return Encoder(path)


def write(docs: DataFrame, path: str, end_id: int = 1, planes: int = 4) -> DataFrame:
    """Writes the ids of docs (doc_id, text) in ascending doc_id order; returns the manifest.

    Manifest: part, path, n_docs, n_ids, start (ids in the files before). Null doc_ids come first,
    rows with equal ids are ordered by their text hash, null texts hold the end id alone. An empty
    table gives an empty manifest. Rows are dealt by ranges of (doc_id, text hash), so that an id
    that repeats very often is spread as well; a task streams its range into one file.
    """
    spark = docs.sparkSession
    folder, end = new_folder(spark, "planes"), np.array([end_id], "<u4").tobytes()

    def write_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        for batch in batches:
            if out is None:
                uri = new_file(folder, f"ids-{part:06d}", ".bpl")
                out = Writer(uri, planes)
            texts = encoder(path).encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts):
                out.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if out is not None:
            n_docs, n_ids = out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "path": [uri], "n_docs": [n_docs], "n_ids": [n_ids]})

    order = [F.col("doc_id"), F.col("__key")]
    ranged = (
        docs.select("doc_id", "text", text_key().alias("__key"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    with arrow_batches(spark, 2_000, BATCH_BYTES):
        files = saved(
            ranged.mapInArrow(write_range, "part int, path string, n_docs long, n_ids long"), "plane-files")
    # One row per file: small enough for one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _documents(file: Reader) -> tuple[pa.Array, np.ndarray]:
    numbers, nulls, lengths = file.documents()
    return pa.array(numbers, pa.int64(), mask=nulls.astype(bool)), lengths


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of a manifest."""

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(batch.column(c).to_pylist() for c in ("path", "start"))):
                file = Reader(uri)
                numbers, lengths = _documents(file)
                sums, pieces, held = [], file.ids(0, file.n_ids), np.empty(0, "<u4")
                for length in lengths.tolist():
                    check = 0
                    while length:
                        if not len(held):
                            held = next(pieces)
                        part, held = held[:length], held[length:]
                        check = zlib.crc32(part.tobytes(), check)
                        length -= len(part)
                    sums.append(check)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": numbers, "start": pa.array(np.cumsum(lengths) - lengths + base),
                    "n_tokens": pa.array(lengths), "ids_crc32": pa.array(sums, pa.int64())})

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(
        read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_of(manifest: DataFrame) -> DataFrame:
    """doc_id, start, ids of every document in the files: the way back to token ids."""

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(batch.column(c).to_pylist() for c in ("path", "start"))):
                file = Reader(uri)
                numbers, lengths = _documents(file)
                at = 0
                for k, length in enumerate(lengths.tolist()):
                    ids = np.concatenate([np.empty(0, "<u4"), *file.ids(at, length)]).astype(np.int32)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": numbers[k:k + 1], "start": pa.array([at + base], pa.int64()),
                        "ids": pa.array([ids], pa.list_(pa.int32()))})
                    at += length

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(read_files, "doc_id long, start long, ids array<int>")

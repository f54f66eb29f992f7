"""Byte-level BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

Which tokens a prefix gets can depend on later bytes, but only so far: a merge (u, v) applies if v
stands whole at its place, which needs v's own end settled and v not taken by an earlier merge to
its right. Walking the merge list once gives for every token the bytes, from its start, that settle
it (`lookahead`). Tokens that end that far before the end of the buffer never change: they leave the
transducer at once, and the buffer stays below one block, the lookahead and a token, however long a piece is.
Text between pieces is cut by the tokenizer's own pattern, window by window.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import small_batches

BLOCK_BYTES = 1_024
WINDOW_CHARS = 65_536
CACHED_WORDS = 150_000
CACHED_CHARS = 64
SHORT_BYTES = 48

# Fixed value: the pattern that byte-level BPE cuts text with before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: 256 + n for n, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


class Vocabulary:
    """Merge list, ids and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids = data["model"]["vocab"]
        symbols = byte_symbols()
        value = {s: b for b, s in enumerate(symbols)}
        self.of_byte = [ids[s] for s in symbols]
        self.merges = []  # (left id, right id, merged id) by rank
        for rule in data["model"]["merges"]:
            left, right = rule if isinstance(rule, list) else rule.split(" ")
            self.merges.append((ids[left], ids[right], ids[left + right]))
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.to_bytes = {i: bytes(value[c] for c in token) for token, i in ids.items()
                         if token not in self.special}
        self.to_bytes |= {i: content.encode() for content, i in self.special.items()}
        self.rank = {}
        for rank, (left, right, _) in enumerate(self.merges):
            self.rank.setdefault((left, right), rank)
        self.lookahead = lookahead(self.merges, {i: len(b) for i, b in self.to_bytes.items()})


def lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Bytes that suffice, from where a token starts, to know that it stays as it is.

    settle[t] is that number for token t as far as the rules read so far go. Rule (u, v) needs u and
    then whatever settles v; from then on the rule can take u, so u is settled no sooner than that.
    """
    settle = dict(length)
    for left, right, merged in merges:
        need = length[left] + settle[right]
        settle[left] = max(settle[left], need)
        settle[merged] = max(settle[merged], need)
    return max(settle.values(), default=1)


class Transducer:
    """Bytes of one piece in, token ids out as soon as they are stable."""

    def __init__(self, vocabulary: Vocabulary, block: int = BLOCK_BYTES):
        self.v, self.block, self.buffer = vocabulary, block, b""

    def push(self, data: bytes) -> Iterator[int]:
        for low in range(0, len(data), self.block):
            self.buffer += data[low:low + self.block]
            if len(self.buffer) >= self.block + self.v.lookahead:
                stable, at = len(self.buffer) - self.v.lookahead, 0
                for token in merge(self.v, self.buffer):
                    end = at + len(self.v.to_bytes[token])
                    if end > stable:
                        break
                    yield token
                    at = end
                self.buffer = self.buffer[at:]

    def finish(self) -> list[int]:
        data, self.buffer = self.buffer, b""
        return merge(self.v, data)


def merge(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """Token ids of bytes: best rule first, leftmost first. Most pieces are a few bytes long, for which
    looking through all pairs is cheaper than a heap."""
    return (_merge_short if len(data) <= SHORT_BYTES else _merge_long)(vocabulary, data)


def _merge_short(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """By the least of all rules that fit, again and again: quadratic."""
    find, merges = vocabulary.rank.get, vocabulary.merges
    none = len(merges)
    ids = list(map(vocabulary.of_byte.__getitem__, data))
    ranks = list(map(find, zip(ids, ids[1:]), repeat(none)))
    while ranks and (rank := min(ranks)) < none:
        at = ranks.index(rank)
        merged = merges[rank][2]
        ids[at] = merged
        del ids[at + 1], ranks[at]
        if at:
            ranks[at - 1] = find((ids[at - 1], merged), none)
        if at < len(ranks):
            ranks[at] = find((merged, ids[at + 1]), none)
    return ids


def _merge_long(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """By a heap over a linked list."""
    of_byte, find, merges = vocabulary.of_byte, vocabulary.rank.get, vocabulary.merges
    ids = [of_byte[b] for b in data]
    count = len(ids)
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    heap = [(rule, at) for at, pair in enumerate(zip(ids, ids[1:])) if (rule := find(pair)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, at = heapq.heappop(heap)
        left, right, merged = merges[rank]
        then = after[at]
        if ids[at] != left or then >= count or ids[then] != right:
            continue
        ids[at], ids[then] = merged, -1
        after[at] = follows = after[then]
        if follows < count:
            before[follows] = at
            if (rule := find((merged, ids[follows]))) is not None:
                heapq.heappush(heap, (rule, at))
        prior = before[at]
        if prior >= 0 and (rule := find((ids[prior], merged))) is not None:
            heapq.heappush(heap, (rule, prior))
    return [i for i in ids if i >= 0]


class Bounded(dict):
    """Results by text, worked out when first asked for. When full it becomes the older generation,
    from which what is asked for again comes back; so it holds at most 2 * CACHED_WORDS. Long texts
    are not kept."""

    def __init__(self, work):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, text: str):
        result = self.older[text] if text in self.older else self.work(text)
        if len(text) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[text] = result
        return result


class Encoder:
    """Ids of whole texts, as groups of ids in order.

    A space after a character that is no white space always starts a piece. So a text is split there,
    and what follows a space has ids of its own, kept for the words that return.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cut = regex.compile(PIECES)
        self.piece, self.word = Bounded(self._piece), Bounded(self._word)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        if len(data) <= BLOCK_BYTES:  # a transducer would keep it all to the end
            return tuple(merge(self.v, data))
        transducer = Transducer(self.v)
        return (*transducer.push(data), *transducer.finish())

    def _word(self, word: str) -> tuple[int, ...] | None:
        """Ids of a space and this; None if white space at its end joins what follows."""
        if word.isalpha():  # letters alone are one piece
            return self.piece[" " + word]
        if not word or word[-1].isspace():
            return None
        return tuple(chain.from_iterable(map(self.piece.__getitem__, self.cut.findall(" " + word))))

    def _plain(self, text: str, at: int, stop: int) -> Iterator[tuple[int, ...]]:
        while at < stop:
            end = min(stop, at + WINDOW_CHARS)
            if end < stop:
                space = text.rfind(" ", at + 1, end)
                while space > at and text[space - 1].isspace():
                    space = text.rfind(" ", at + 1, space)
                if space <= at:
                    at = yield from self._window(text, at, end, stop)
                    continue
                end = space
            first, *rest = text[at:end].split(" ")
            found = list(map(self.word.__getitem__, rest))
            if not all(found):
                found = map(self.piece.__getitem__, self.cut.findall(text, at, end))
            else:
                yield from map(self.piece.__getitem__, self.cut.findall(first))
            yield tuple(chain.from_iterable(found))
            at = end

    def _window(self, text: str, at: int, end: int, stop: int):
        """A window without a place to split: all its pieces but the last, which what follows can
        change; if there is only one, that whole piece, passed through a transducer. Returns where
        the rest begins."""
        found = self.cut.findall(text, at, end)
        if len(found) > 1:
            yield from map(self.piece.__getitem__, found[:-1])
            return end - len(found[-1])
        transducer = Transducer(self.v)
        end = self.cut.match(text, at, stop).end()
        for low in range(at, end, WINDOW_CHARS):
            yield tuple(transducer.push(text[low:min(end, low + WINDOW_CHARS)].encode()))
        yield tuple(transducer.finish())
        return end

    def groups(self, text: str | None) -> Iterator[tuple[int, ...]]:
        text, at = text or "", 0
        if self.special and "<" in text:
            for hit in self.special.finditer(text):
                yield from self._plain(text, at, hit.start())
                yield (self.v.special[hit[0]],)
                at = hit.end()
        yield from self._plain(text, at, len(text))

    def ids(self, text: str | None) -> Iterator[int]:
        """Token ids of a text in order; null is the empty text."""
        return chain.from_iterable(self.groups(text))


class Decoder:
    """Token ids in, text out; a character split over tokens waits for its last byte."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = vocabulary.to_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(Vocabulary(path))


def _encode(path: str, keep_ids: bool):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        decode = Decoder(encode.v)
        for texts in batches:
            rows = []
            for text in texts:
                ids = np.fromiter(encode.ids(text), "<u4")
                ids_hash, text_hash = hashlib.sha256(ids), hashlib.sha256()
                for low in range(0, len(ids), 8_192):
                    text_hash.update(decode.push(ids[low:low + 8_192].tolist()).encode())
                text_hash.update(decode.finish().encode())
                row = (len(ids), ids_hash.hexdigest(), text_hash.hexdigest())
                rows.append((*row, ids.astype(np.int32)) if keep_ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][:3 + keep_ids]
            yield pd.DataFrame(rows, columns=names)

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return F.pandas_udf(run, schema)


def tokenize(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 (and ids) of every text; text itself leaves.

    Null and empty texts have no tokens. Special tokens of the file that stand in a text become their
    ids. Rows keep their order and number; a column of docs named like a new one gives way. A map
    over rows: nothing is shuffled, and memory holds one batch of texts and a bounded cache.
    """
    small_batches(docs.sparkSession, 200)
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    rest = [F.col(c) for c in docs.columns if c not in (*new, "text")]
    run = _encode(path, keep_ids)
    return docs.select(*rest, run("text").alias("__t")).select(
        *rest, *[F.col(f"__t.{c}").alias(c) for c in new])


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def detokenize(tokens: DataFrame, path: str) -> DataFrame:
    """tokens (ids array<int>, ...) with their text instead; null ids give a null text."""

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        decode = Decoder(vocabulary(path))
        return pd.Series([None if x is None else decode.push(list(x)) + decode.finish() for x in ids])

    return tokens.withColumn("text", text_of("ids")).drop("ids")

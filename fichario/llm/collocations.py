"""Collocations: phrases of two or three words that stand together more often than their parts.

Level by level, as Apriori allows: a phrase can be frequent only if its words are.

1. One pass over the texts counts words. Those that reach the smallest count that matters get numbers.
2. A second pass writes texts in these numbers and counts the phrases of two and three numbered words run by
   run; a phrase is one 64-bit key. The counts are dealt by a hash of the key into blocks of about BLOCK_ROWS
   rows, packed, and a block is summed by sorting: the counts are exact, and those that reach the smallest
   count are the candidates of both levels.

So the texts are read twice whatever the corpus, and every phrase moves once per run; a hot word or pair is one
row per run, in no block more than another. The numbered words are broadcast: at most about MOST_WORDS of
MOST_BYTES bytes, the most frequent ones. Where a corpus has more, phrases with one of the others are counted
in a third pass and moved as text.

`Trie` holds a list of phrases as a double array over word numbers (two digits of RADIX each; a word is two
steps); numpy moves the states of all positions of a batch at once. It finds given phrases in texts; counting
needs none, since a list that grows with the corpus would take ever more passes over it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fichario.llm.common import arrow_batches, saved

MIN_COUNT = 10
TOP = 2_000
HOLD = 50  # percent of a phrase's places that lie inside a longer candidate
MOST_WORDS = 2_000_000
MOST_BYTES = 1 << 26
RUN_TOKENS = 3_000_000
BLOCK_ROWS = 1_000_000
BITS = 21  # of a word's number, three in a key
BATCH_BYTES = 2 << 20
RADIX = 1_024
MARK = b"."  # between pieces: no word, as it cuts pieces
# A-Z in lower case, tab as space, what cuts pieces as line feed.
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of all texts, MARK between pieces and behind every text."""
    flat = b"\n".join(texts).translate(_TABLE).replace(b"\n", b" . ").split()
    flat.append(MARK)
    return flat


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    groups: dict[str, list[bytes]] = {}
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for lang, text in zip(batch.column("lang").to_pylist(), texts):
        groups.setdefault(lang, []).append(text)
    for lang, own in groups.items():
        yield lang, tokens(own)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """The texts of a task by language, in runs of about RUN_TOKENS: the distinct words, MARK first, and the
    place of every word of the texts among them."""
    langs, held = {}, 0

    def made() -> Iterator[tuple[str, pa.Array, np.ndarray]]:
        while langs:
            lang, (numbers, parts) = langs.popitem()
            yield lang, pa.array(list(numbers), pa.binary()), np.concatenate(parts)

    for batch in batches:
        for lang, found in _by_lang(batch):
            if lang not in langs:
                langs[lang] = defaultdict(count().__next__), []
                langs[lang][0][MARK]  # noqa: B018  number 0
            numbers, parts = langs[lang]
            parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
            held += len(found)
        if held >= RUN_TOKENS:
            yield from made()
            held = 0
    yield from made()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words; the empty phrase has the number of all."""
    for lang, words, at in _runs(batches):
        sizes = np.bincount(at, minlength=len(words))
        yield _counted(lang, pa.array([b""], pa.binary()), np.array([sizes[1:].sum()]))
        for low in range(1, len(words), 200_000):
            yield _counted(lang, words.slice(low, 200_000), sizes[low:low + 200_000])


def _counted(lang: str, phrases: pa.Array, sizes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), np.int64))),
         phrases.cast(pa.string()), pa.array(sizes, pa.int64())], names=["lang", "phrase", "n"])


class Trie:
    """Double array of phrases (lang, phrase): base, check and the number of the phrase at a state.

    The state behind the first word is its number; states from there on are slots of the double array.
    accept holds at a state the phrase's place in `ids` plus one, or zero.
    """

    def __init__(self, langs: list[str], phrases: list[bytes], ids: np.ndarray):
        self.numbers: dict[str, dict[bytes, int]] = {}
        fresh, self.ids = count(1), ids
        symbols = np.zeros((len(phrases), 3), np.int64)
        for n, (lang, phrase) in enumerate(zip(langs, phrases)):
            own = self.numbers.setdefault(lang, {})
            for k, word in enumerate(phrase.split(b" ")):
                symbol = own.get(word)
                if symbol is None:
                    symbol = own[word] = next(fresh)
                symbols[n, k] = symbol
        words = next(fresh)
        # Nodes level by level: first words, then two digits for each further word.
        node, slot_of = symbols[:, 0].copy(), [np.arange(words)]
        levels, total = [], words
        final = node.copy()
        for k in (1, 2):
            there = symbols[:, k] > 0
            for digit in (symbols[:, k] // RADIX, symbols[:, k] % RADIX):
                keys, inverse = np.unique(node[there] * RADIX + digit[there], return_inverse=True)
                levels.append((keys // RADIX, keys % RADIX))
                node[there] = total + inverse
                total += len(keys)
            final[there] = node[there]
        if words // RADIX >= RADIX:
            raise ValueError("too many words for two digits")
        parents = np.concatenate([p for p, _ in levels])
        codes = np.concatenate([c for _, c in levels])
        slots, bases, size = _placed(parents, codes, max(words, RADIX))
        slot_of = np.concatenate([slot_of[0], slots])
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.accept = np.zeros(size, np.int32)
        self.base[slot_of[parents]] = bases
        self.check[slots] = slot_of[parents]
        self.accept[slot_of[final]] = np.arange(1, len(phrases) + 1)

    def read(self, lang: str, found: list[bytes]) -> np.ndarray | None:
        """Numbers of the words, zero for marks and words of no phrase."""
        own = self.numbers.get(lang)
        return own and np.fromiter(map(own.get, found, repeat(0)), np.int32, len(found))

    def advance(self, at: np.ndarray, states: np.ndarray, symbols: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and states that live on with the word `ahead` places behind the position."""
        at, states = at[at + ahead < len(symbols)], states[at + ahead < len(symbols)]
        for digit in (lambda w: w // RADIX, lambda w: w % RADIX):
            word = symbols[at + ahead]
            there = self.base[states] + digit(word)
            alive = (word > 0) & (self.check[there] == states)
            at, states = at[alive], there[alive]
        return at, states

    def pairs(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(symbols)
        return self.advance(at, symbols[at], symbols, 1)


def _placed(parents: np.ndarray, codes: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A slot for every node, in slots from low on, such that the nodes of a parent stand at its base
    plus their codes; the bases, and the size that holds every base plus any code.

    Parents with many children go one by one to the first of a few places that fits or to the end;
    those with a few are thrown at random places all at once, those that collide again, with more room
    after some throws; an only child takes any free slot.
    """
    order = np.argsort(parents, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(parents[order]) != 0]) if len(order) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[begin, len(order)])
    random = np.random.default_rng(5)
    end = low + int(1.25 * len(codes)) + 2 * RADIX
    used = np.zeros(end + RADIX, bool)
    group_base = np.zeros(len(begin), np.int64)

    def grown(more: int) -> None:
        nonlocal used, end
        end += more
        used = np.r_[used, np.zeros(more, bool)]

    for g in np.flatnonzero(sizes >= 24)[np.argsort(-sizes[sizes >= 24], kind="stable")]:
        own = codes[order[begin[g]:begin[g] + sizes[g]]]
        for base in random.integers(low, end, 12).tolist():
            if not used[base + own].any():
                break
        else:
            base = end
            grown(RADIX)
        used[base + own] = True
        group_base[g] = base
    left = np.flatnonzero((sizes > 1) & (sizes < 24))
    throws = 0
    while len(left):
        throws += 1
        if throws % 12 == 0:
            grown(int(2 * sizes[left].sum()) + RADIX)
        base = random.integers(low, end, len(left))
        which = np.repeat(np.arange(len(left)), sizes[left])
        within = np.arange(len(which)) - np.repeat(np.cumsum(sizes[left]) - sizes[left], sizes[left])
        slot = base[which] + codes[order[begin[left][which] + within]]
        bad = used[slot]
        _, first = np.unique(slot, return_index=True)
        own = np.zeros(len(slot), bool)
        own[first] = True
        fits = np.bincount(which, weights=bad | ~own, minlength=len(left)) == 0
        used[slot[fits[which]]] = True
        group_base[left[fits]] = base[fits]
        left = left[~fits]
    lone = np.flatnonzero(sizes == 1)
    grown(max(0, len(lone) - int((~used[low + RADIX:end]).sum())) + RADIX)
    free = low + RADIX + np.flatnonzero(~used[low + RADIX:end])
    group_base[lone] = free[:len(lone)] - codes[order[begin[lone]]]
    bases = np.empty(len(order), np.int64)
    bases[order] = np.repeat(group_base, sizes)
    return bases + codes, bases, len(used) + RADIX


class Numbered:
    """The numbered words of a language, from one on, and the blocks that its phrases are dealt to."""

    def __init__(self, words: pa.Array, blocks: int):
        self.words, self.blocks = words, blocks

    def read(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words, zero for those without."""
        place = pc.index_in(self.words, value_set=words).fill_null(-1).to_numpy()
        there = np.flatnonzero(place >= 0)
        numbers = np.zeros(len(words), np.int64)
        numbers[place[there]] = there + 1
        return numbers

    def phrases(self, keys: np.ndarray) -> pa.Array:
        """The phrases of keys that all have a third word, or none."""
        parts = [keys >> 2 * BITS, keys >> BITS & (1 << BITS) - 1, keys & (1 << BITS) - 1]
        if len(keys) and not parts[2][0]:
            parts.pop()
        return pc.binary_join_element_wise(
            *[self.words.take(pa.array(part - 1)) for part in parts], pa.scalar(b" ", pa.binary()))


def _packed(keys: np.ndarray, sizes: np.ndarray) -> bytes:
    """Sorted keys and their counts: differences as byte planes, most of them zero, compressed."""
    steps = np.diff(keys, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8)
    planes = steps.T.tobytes() + sizes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, rows: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 12 * rows, "zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes[:8 * rows].reshape(8, rows).T).view("<i8").ravel()
    sizes = np.ascontiguousarray(planes[8 * rows:].reshape(4, rows).T).view("<i4").ravel()
    return np.cumsum(steps), sizes.astype(np.int64)


def _dealt(book) -> Callable:
    """Counts of the phrases of numbered words: a row (lang, block, size, data) per run and block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, at in _runs(batches):
            own = book.value.get(lang)
            if own is None:
                continue
            code = own.read(words)[at]
            joint = (code[:-1] > 0) & (code[1:] > 0)
            pairs = code[:-1] << 2 * BITS | code[1:] << BITS
            triples = (pairs[:-1] | code[2:])[joint[:-1] & (code[2:] > 0)]
            keys, sizes = np.unique(np.concatenate([pairs[joint], triples]), return_counts=True)
            block = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(own.blocks)).astype(np.uint16)
            order = np.argsort(block, kind="stable")
            keys, sizes, held = keys[order], sizes[order], np.bincount(block, minlength=own.blocks)
            ends = np.cumsum(held)
            rows, weight = [], 0
            for n in np.flatnonzero(held).tolist():
                data = _packed(keys[ends[n] - held[n]:ends[n]], sizes[ends[n] - held[n]:ends[n]])
                rows.append((n, held[n], data))
                weight += len(data)
                if weight >= BATCH_BYTES or n == block[order[-1]]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows), pa.string()), *map(pa.array, zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                        names=["lang", "block", "size", "data"])
                    rows, weight = [], 0

    return find


def _summed(book, least: int) -> Callable:
    """(lang, phrase, n) that reach `least`, of rows sorted by language and block; holds one block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, sizes = map(np.concatenate, zip(*parts))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            return keys[edges], np.add.reduceat(sizes[order], edges)

        def flush() -> Iterator[pa.RecordBatch]:
            keys, sizes = merged()
            keys, sizes = keys[sizes >= least], sizes[sizes >= least]
            two = keys & (1 << BITS) - 1 == 0
            for which in (two, ~two):
                if which.any():
                    yield _counted(now[0], book.value[now[0]].phrases(keys[which]), sizes[which])

        for batch in batches:
            for lang, block, size, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "size", "data"))):
                if now != (lang, block):
                    if parts:
                        yield from flush()
                    now, parts, held, after = (lang, block), [], 0, 4 * BLOCK_ROWS
                parts.append(_unpacked(data, size))
                held += size
                if held > after:  # a block of many repeats: their sums take less
                    parts = [merged()]
                    held = len(parts[0][0])
                    after = max(after, 2 * held)
        if parts:
            yield from flush()

    return find


def _as_text(book) -> Callable:
    """Counts of the phrases with a word that has no number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, at in _runs(batches):
            own = book.value.get(lang)
            bare = (own.read(words) if own else np.zeros(len(words), np.int64))[at] == 0
            at = at.astype(np.int64)
            joint = (at[:-1] > 0) & (at[1:] > 0)
            pairs, place = np.unique(at[:-1] * len(words) + at[1:], return_inverse=True)
            two = joint & (bare[:-1] | bare[1:])
            three = joint[:-1] & joint[1:] & (bare[:-2] | bare[1:-1] | bare[2:])
            for longer, codes in enumerate((pairs[place[two]], (place[:-1] * len(words) + at[2:])[three])):
                codes, sizes = np.unique(codes, return_counts=True)
                for low in range(0, len(codes), 200_000):
                    head, last = np.divmod(codes[low:low + 200_000], len(words))
                    heads = np.divmod(pairs[head], len(words)) if longer else [head]
                    joined = pc.binary_join_element_wise(
                        *[words.take(pa.array(part)) for part in (*heads, last)], pa.scalar(b" ", pa.binary()))
                    yield _counted(lang, joined, sizes[low:low + 200_000])

    return find


def _numbered(words: DataFrame, most: int) -> tuple[dict[str, Numbered], bool]:
    """The numbered words by language, at most `most` and the most frequent ones, and whether these are all."""
    held = words.filter("phrase <> ''")
    step = F.floor(4 * F.log2("n"))
    steps = held.groupBy(step.alias("step")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("phrase")).alias("size")).orderBy(F.desc("step")).collect()
    number = size = 0
    kept = []
    for row in steps:
        number, size = number + row.n, size + row["size"]
        if number > most or size > MOST_BYTES:
            break
        kept.append(row.step)
    book = {}
    if kept:
        known = held.filter(step >= kept[-1])
        rows = known.select("lang", F.col("phrase").cast("binary").alias("word")).toArrow().sort_by("lang").combine_chunks()
        total = dict(words.filter("phrase = ''").join(known.select("lang").distinct(), "lang", "left_semi").select("lang", "n").collect())
        low, langs = 0, pc.run_end_encode(rows.column("lang").combine_chunks())
        for lang, high in zip(langs.values.to_pylist(), langs.run_ends.to_pylist()):
            own = rows.column("word").slice(low, high - low).combine_chunks()
            book[lang] = Numbered(own, min(-(-2 * total[lang] // BLOCK_ROWS), 1 << 16))
            low = high
    return book, len(kept) == len(steps)


def counts(docs: DataFrame, least: int = MIN_COUNT, most: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Words (lang, phrase, n; the empty phrase has the number of all words) and candidates (lang,
    phrase, n) of two and three words that stand at least `least` times in a language; at most `most`
    words get numbers."""
    spark = docs.sparkSession
    texts = docs.filter("text is not null").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    shape = "lang string, phrase string, n long"

    def frequent(rows: DataFrame) -> DataFrame:
        return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(
            (F.col("n") >= least) | (F.col("phrase") == ""))

    with arrow_batches(spark, 2_000, BATCH_BYTES):
        words = saved(frequent(texts.mapInArrow(_words, shape)), "words")
        book, whole = _numbered(words, min(most, (1 << BITS) - 1))
        sent = spark.sparkContext.broadcast(book)
        dealt = texts.mapInArrow(_dealt(sent), "lang string, block int, size long, data binary")
        phrases = saved(
            dealt.repartition("lang", "block").sortWithinPartitions("lang", "block").mapInArrow(
                _summed(sent, least), shape), "phrases")
        if not whole:
            phrases = phrases.unionByName(saved(frequent(texts.mapInArrow(_as_text(sent), shape)), "phrases-as-text"))
        sent.destroy()
    return words, phrases


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, most: int = MOST_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of every language of docs (lang, text).

    Texts are lower-cased (A-Z), cut at `[.,;:!?\\x0A-\\x0D]`, then at spaces and tabs. a, l and r are the
    places of the phrase and of the two parts of its worst cut, n all words of the language, the score
    floor(1,000,000 * a * a / (l * r)). A phrase mostly found inside a longer candidate leaves. Null texts
    are empty, a null language is `und`. Repeated rows count as often as they come; an empty table or one
    without frequent phrases gives no rows. Ties go by a, then by the bytes of the phrase.
    """
    words, phrases = counts(docs, least, most)
    words = words.select("lang", F.col("phrase").alias("key"), F.col("n").alias("f"))
    part = F.split("phrase", " ")
    phrases = phrases.withColumnRenamed("n", "a").withColumn("part", part)
    pairs, triples = phrases.filter(F.size("part") == 2), phrases.filter(F.size("part") == 3)
    known = pairs.select("lang", F.col("phrase").alias("key"), F.col("a").alias("f"))

    def met(rows: DataFrame, table: DataFrame, first: int, length: int, name: str) -> DataFrame:
        key = F.array_join(F.slice("part", first, length), " ")
        return rows.withColumn("key", key).join(table, ["lang", "key"]).withColumnRenamed("f", name).drop("key")

    def score(left: str, right: str):
        return F.expr("cast(1000000 as decimal(38,0)) * cast(a as decimal(20,0)) * cast(a as decimal(20,0)) "
                      f"div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")

    two = met(met(pairs, words, 1, 1, "l"), words, 2, 1, "r")
    inside = triples.select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("part", 1, 2), " "), F.array_join(F.slice("part", 2, 2), " "))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = two.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < HOLD * F.col("a"))
    ).select("lang", "phrase", "a", "l", "r", score("l", "r").alias("score"))
    three = met(met(met(met(triples, words, 1, 1, "l1"), known, 2, 2, "r1"), known, 1, 2, "l2"), words, 3, 1, "r2")
    three = three.withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "phrase", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    # A language may hold most rows: first the best of each of some parts, then of these.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(
        F.col("rank") <= top)
    total = words.filter("key = ''").select("lang", F.col("f").alias("n"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(
        F.col("rank") <= top).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

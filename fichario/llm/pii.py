"""Personal data: fixed patterns, and identifiers found by the contexts that seeds teach.

One pass over the texts gives the base spans and, for every token that could be an identifier, its
contexts. A token could be one if it has digits and four characters, or stands behind a label (`key:`,
`key = "`) and has eight; groups that follow it (`DE89 3704 0044`) belong to it. Nothing has an upper
length. A context is the two words before, or the label with its punctuation and without its spaces,
so `token = "x"` and `token="x"` are one. Both are kept as hashes. From then on only these short
occurrences are worked on, as DataFrames:

    seeds      the base spans, whatever their kind, and tokens shaped like keys (long, letters and
               digits in constant change), with their contexts
    patterns   contexts of at least MIN_SEEDS different seeds, whatever the size of the corpus
    corpus     how often each pattern occurs at all, whatever follows, over all texts; before that,
               counts over parts of the texts rule out what could not be confident even if all that
               was found after it were personal data
    graph      pattern - instance edges with counts, aggregated before every shuffle
    scores     a pattern scores the confidence that follows it per occurrence in the corpus; an
               instance scores by its best patterns together (noisy or); some rounds
    discovery  occurrences that confident patterns cover become spans of kind id, base spans aside

So a pattern has to precede personal data nearly always before anything is taken on its word; common
prose that happens to precede an address somewhere never does. A token shaped like a key is a span
only behind a confident pattern: the shape teaches, it does not decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import saved, small_batches, text_key, words

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
ROUNDS = 3
MIN_SEEDS = 3
MIN_PATTERN = 0.8
PRIOR = 2.0  # occurrences of confidence zero that every pattern starts with
PARTS = (256, 16)  # one text in so many is counted first: a count in a part is a lower bound

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACES = " \t\n\x0b\x0c\r"
_MARKS = "=:#"
_BETWEEN = "=:# \t\"'(<["
_TRIGGER = re.compile(r"[0-9]++|[=:#][=:#\x20\t\"'(<\[]*+")
_GROUP = re.compile(r"[A-Z]*+[0-9][0-9A-Z]++")
_NEXT_GROUP = re.compile(r"\x20[A-Z]*+[0-9][0-9A-Z]*+(?![^\x20\x09-\x0D.,;:!?\"')\]>}])")
_KEY = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
_CHANGE = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
# a label with what stands between it and the next word
_LABEL = (r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_]++(?=[\x20\t\"'(<\[]*+[=:#])[=:#\x20\t\"'(<\[]++"
          r"(?=[^\x20\x09-\x0D])")
MIN_TOKEN, MIN_LABELLED = 4, 8  # characters, with and without digits
ROW_PATTERNS = 10_000  # so few are looked up inside the row, before its contexts become rows
BROADCAST_PATTERNS = 1_000_000  # rows of 8 bytes; beyond that the patterns are joined by shuffle

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    """From every @ to the left as far as a local part may go: the leftmost match, in linear time."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and (text[begin - 1] in "._%+-" or (text[begin - 1].isascii() and text[begin - 1].isalnum())):
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            spans.append((begin, end))
        at = text.find("@", max(at + 1, end))
    return spans


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        value = int(c) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> dict[str, list[Span]]:
    """Spans of every base kind, leftmost and not overlapping within a kind."""
    text = text or ""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text) is None:
        return out
    if "." in text:
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def shaped_like_key(token: str) -> bool:
    """Long, of the characters of keys, and changing between letters and digits all along."""
    return _KEY.fullmatch(token) is not None and 8 * len(_CHANGE.findall(token)) >= len(token)


def _candidates(text: str, taken: list[Span]) -> Iterator[Span]:
    """Tokens that could be identifiers and touch no base span, in linear time."""
    at, next_, word = 0, 0, 0  # word: where the last word ends
    for hit in _TRIGGER.finditer(text):
        begin, end = hit.span()
        if begin < at:
            continue
        if labelled := text[begin] in _MARKS:
            begin = end
            if begin == len(text) or text[begin] in _SPACES:
                continue
        else:
            while begin > at and text[begin - 1] not in _SPACES:
                begin -= 1
        if begin >= word:
            word = _WORD.match(text, begin).end()
        end = word
        if labelled and (inner := _TRIGGER.search(text, begin, end)) and set("=\"'") & set(inner[0]):
            continue  # a label of its own: its turn comes
        at = end
        while begin < end and not (text[begin].isascii() and (text[begin].isalnum() or text[begin] in "+@")):
            begin += 1
        while end > begin and not (text[end - 1].isascii() and text[end - 1].isalnum()):
            end -= 1
        plain = labelled and _DIGIT.search(text, begin, end) is None
        if end - begin < (MIN_LABELLED if plain else MIN_TOKEN):
            continue
        while next_ < len(taken) and taken[next_][1] <= begin:
            next_ += 1
        limit = taken[next_][0] if next_ < len(taken) else len(text)
        if _GROUP.fullmatch(text, begin, end):
            while (more := _NEXT_GROUP.match(text, end)) and more.end() <= limit:
                end = more.end()
            at = max(at, end)
        if end <= limit:
            yield begin, end


def _before(text: str, at: int) -> Span:
    """The word that ends before a place; empty where there is none."""
    while at and text[at - 1] in _SPACES:
        at -= 1
    begin = at
    while begin and text[begin - 1] not in _SPACES:
        begin -= 1
    return begin, at


def _label(text: str, at: int) -> str | None:
    """The label before a place: a word, then punctuation with a mark in it; spaces left out."""
    end = at
    while end and text[end - 1] in _BETWEEN:
        end -= 1
    between = text[end:at]
    if not any(mark in between for mark in _MARKS):
        return None
    begin = end
    while begin and (text[begin - 1].isalnum() or text[begin - 1] == "_"):
        begin -= 1
    return text[begin:end].lower() + re.sub("[ \t]+", "", between) if begin < end else None


def occurrences(text: str | None, spans: dict[str, list[Span]]) -> Iterator[tuple[int, int, int, bool, bool, int]]:
    """(start, end, instance, is seed, is open, pattern) of base spans and other candidates, once per
    context; open ones are no base spans. Instance (value in lower case) and pattern are hashes."""
    text = text or ""
    taken = sorted(span for found in spans.values() for span in found)
    places = [(s, e, True, False) for s, e in taken]
    places += [(s, e, shaped_like_key(text[s:e]), True) for s, e in _candidates(text, taken)]
    word, end, two = 0, 0, None
    for start, stop, seed, open_ in sorted(places):
        if not word <= start < end:  # another word than the last place's
            word, low = start, end if end <= start else 0
            while word > low and text[word - 1] not in _SPACES:
                word -= 1
            end = _WORD.match(text, start).end()
            last = _before(text, word)
            first = _before(text, last[0])
            two = f"{text[slice(*first)]} {text[slice(*last)]}".lower() if first[0] < first[1] else None
        for pattern in (two, _label(text, start)):
            if pattern is not None:
                yield start, stop, pattern_hash(text[start:stop].lower()), seed, open_, pattern_hash(pattern)


def _joined(kind: str, spans: list[Span]) -> list[str]:
    return [f"{kind}:{s}:{e}" for s, e in spans]


SCAN = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("row_id", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()),
    ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base", pa.string()),
    ("found", pa.list_(pa.struct([
        ("start", pa.int64()), ("stop", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()),
        ("open", pa.bool_()), ("h", pa.int64())])))])
FOUND_FIELDS = ("start", "stop", "instance", "seed", "open", "h")
SCAN_DDL = (
    "doc_id long, text_key long, row_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "found array<struct<start: long, stop: long, instance: long, seed: boolean, open: boolean, h: long>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        ids, keys, numbers = (batch.column(c).to_pylist() for c in ("doc_id", "text_key", "row_id"))
        for doc_id, key, number, text in zip(ids, keys, numbers, batch.column("text").to_pylist()):
            spans = base_spans(text)
            base = [s for kind in KINDS for s in _joined(kind, spans[kind])]
            found = [dict(zip(FOUND_FIELDS, x)) for x in occurrences(text, spans)]
            rows.append((doc_id, key, number, *[len(spans[k]) for k in KINDS], ",".join(base), found))
        columns = list(zip(*rows)) or [()] * len(SCAN)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCAN)], schema=SCAN)


def corpus_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """h, total: how often each of patterns (h) stands before any word, over all texts."""
    n = patterns.count()
    text = F.coalesce(F.col("text"), F.lit(""))
    pairs = F.transform(
        F.sequence(F.lit(2), F.size("w") - 1),
        lambda i: F.xxhash64(F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1))))
    labels = F.transform(
        F.regexp_extract_all(text, F.lit(_LABEL), F.lit(0)),
        lambda x: F.xxhash64(F.lower(F.regexp_replace(x, r"[\x20\t]+", ""))))
    kept = (pairs, labels)
    if n <= ROW_PATTERNS:
        wanted = [r.h for r in patterns.collect()]
        kept = tuple(F.filter(x, lambda h: h.isin(wanted)) for x in kept)
    none = F.array().cast("array<bigint>")
    hashes = F.concat(F.when(F.size("w") > 2, kept[0]).otherwise(none), kept[1])
    all_ = docs.select("text", words(F.lower("text")).alias("w")).select(F.explode(hashes).alias("h"))
    if n > ROW_PATTERNS:
        all_ = all_.join(F.broadcast(patterns) if n <= BROADCAST_PATTERNS else patterns, "h")
    return all_.groupBy("h").agg(F.count("*").alias("total"))


def scored_patterns(found: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """h (hash of the pattern), score from occurrences (instance, seed, h) and the texts.

    Score: confidence that follows the pattern / (its occurrences in the corpus + PRIOR). Confidence
    of an instance: 1 if it is a seed, else 1 minus the product of (1 - score) over its patterns that
    reach MIN_PATTERN. Every round is saved.

    Patterns that cannot reach MIN_PATTERN leave before all texts are counted, which changes no result:
    the confidence that follows a pattern is at most the occurrences found after it, and its count in a
    part of the texts is at most its count in all.
    """
    edges = found.groupBy("h", "instance").agg(
        F.count("*").alias("n"), F.max("seed").alias("seed"))
    edges = saved(edges, "pii-edges")
    induced = saved(
        edges.groupBy("h").agg(F.sum("n").alias("most"), F.count_if("seed").alias("seeds"))
        .filter((F.col("seeds") >= MIN_SEEDS) & (F.col("most") / PRIOR >= MIN_PATTERN)).select("h", "most"),
        "pii-induced")
    for part in PARTS:
        seen = corpus_counts(docs.filter(F.pmod(text_key(), F.lit(part)) == 0), induced.select("h"))
        bound = F.col("most") / (F.coalesce("total", F.lit(0)) + PRIOR)
        induced = saved(
            induced.join(seen, "h", "left").filter(bound >= MIN_PATTERN).select("h", "most"), "pii-induced")
    total = saved(corpus_counts(docs, induced.select("h")), "pii-counts")
    edges = saved(edges.join(total, "h"), "pii-edges")
    confidence = F.when(F.col("seed"), 1.0).otherwise(0.0)
    weighed = edges.select("h", "total", "n", confidence.alias("c"))
    for turn in range(rounds):
        patterns = saved(
            weighed.groupBy("h").agg(
                (F.sum(F.col("n") * F.col("c")) / (F.max("total") + PRIOR)).alias("score"))
            .filter(F.col("score") >= MIN_PATTERN), "pii-patterns")
        if turn + 1 == rounds:
            return patterns
        instances = saved(
            edges.filter("not seed").join(patterns, "h").groupBy("instance").agg(_either().alias("c")),
            "pii-instances")
        weighed = edges.join(instances, "instance", "left").select(
            "h", "total", "n", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("c", F.lit(0.0))).alias("c"))


def _either() -> Column:
    """Noisy or of the scores of a group."""
    return 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """row_id, start, stop of the occurrences whose pattern is confident."""
    open_ = found.filter("open").select("row_id", "start", "stop", "h")
    return open_.join(patterns, "h").select("row_id", "start", "stop").distinct()


def _confident(scan: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences of a scan, and the patterns that discover."""
    found = scan.filter("size(found) > 0").select("row_id", F.inline("found"))
    return found, scored_patterns(found, docs)


def _scanned(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession, 200)
    keyed = docs.select(
        "doc_id", "text", text_key().alias("text_key"), F.monotonically_increasing_id().alias("row_id"))
    return saved(keyed.mapInArrow(_scan, SCAN_DDL), "pii-scan")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_email, n_ip, n_card, n_phone, n_id, base, spans of every row of docs.

    base and spans: kind:start:end by kind, then start, comma-joined, in code points; spans adds the
    discovered ones of kind id at the end. Null and empty texts have none. Discovered spans never
    overlap base spans. Repeated rows are returned as often as they come. An empty table gives no
    rows. Texts are read for the spans, for the patterns' counts in parts and for those in all, and
    never shuffled.
    """
    scan = _scanned(docs)
    found, patterns = _confident(scan, docs)
    spans = discovered(found, patterns)
    more = spans.groupBy("row_id").agg(  # at most the identifiers of one text
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("ids"))
    joined = F.concat_ws(",", F.transform("ids", lambda s: F.concat(
        F.lit(FOUND + ":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))))
    return scan.drop("found").join(more, "row_id", "left").select(
        "doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_id"), "base",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")),
                    F.when(F.size("ids") > 0, joined)).alias("spans"))


def masked(text: str | None, spans: str | None) -> str | None:
    """A text with [KIND] for its spans; where spans of two kinds overlap, one mark covers both."""
    if not text or not spans:
        return text
    places = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",")))
    out, at = [], 0
    for start, stop, kind in places:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def pattern_hash(pattern: str) -> int:
    """What Spark's xxhash64 gives for the pattern."""
    value = xxhash.xxh64_intdigest(pattern.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def _cleaned(text: str | None, good: frozenset[int]) -> str | None:
    base = base_spans(text)
    spans = [s for kind in KINDS for s in _joined(kind, base[kind])]
    ids = {(s, e) for s, e, _, _, open_, h in (occurrences(text, base) if good else ()) if open_ and h in good}
    return masked(text, ",".join(spans + _joined(FOUND, sorted(ids))))


def without_pii(docs: DataFrame) -> DataFrame:
    """docs with all spans masked in text; rows, columns and everything else stay. Null and empty texts
    stay as they are, repeated rows are masked alike, an empty table gives no rows.

    The confident patterns go to the tasks; every text is scanned and masked where it lies. Should there
    ever be more than BROADCAST_PATTERNS, texts meet their spans by doc_id and text hash instead.
    """
    plain = docs.select("doc_id", "text")
    _, patterns = _confident(_scanned(plain), plain)
    if patterns.count() > BROADCAST_PATTERNS:
        return _joined_masks(docs)
    good = frozenset(r.h for r in patterns.select("h").collect())

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([_cleaned(t, good) for t in texts])

    return docs.withColumn("text", clean("text"))


def _joined_masks(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text")).filter("spans <> ''").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans"))
    found = saved(found.dropDuplicates(["__id", "__key"]), "pii-spans")

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([masked(t, s) for t, s in zip(texts, spans)])

    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key"))
    both = docs.join(found, same, "left")
    return both.withColumn("text", mask("text", "__spans")).select(docs.columns)

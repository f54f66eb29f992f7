"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

A text is read as words and typed slots. A word that begins with a capital may be a name wherever it
stands, so every five-token window has two hashes: one with the capitalised words as slots, one with
them as words in lower case. Windows are hash-joined with those of the benchmark items by either, so
other names are met by the first, other capitals (a copy in lower case, a new sentence start) by the
second. A document holds an item if at least four fifths of the item's windows are found in it; then the
slots are compared, in one occurrence of the item or in the whole document: a value of the item must
stand for one value of the document, and only windows that agree with that count. So a question with
other numbers or names is found, while text that only shares the frame by chance is not.

Scripts without spaces are read by character. Windows with fewer than two words besides slots say too
little to let names differ: they have the second hash only. Windows of numbers and units alone do not
count, unless the item has no others; those, and items of fewer than five tokens, which are one
window, must be met value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fichario.llm.common import saved, text_key

WINDOW = 5
SHARE_TENTHS = 8
LEAST_WORDS = 2  # of a window whose names may differ

# Units that follow a number.
UNITS = (
    "mm", "cm", "m", "km", "in", "ft", "mi", "mg", "g", "kg", "t", "lb", "oz", "ml", "l", "s", "ms", "min",
    "h", "hr", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "years", "year",
    "mph", "kmh", "hz", "khz", "mhz", "w", "kw", "v", "a", "j", "kj", "n", "pa", "kpa", "k", "c", "f",
    "usd", "eur", "dollars", "dollar", "euros", "euro", "cents", "percent", "%", "°",
)
END, NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002", "\ue003"  # private use, in this order
# Blocks of scripts that write no spaces between words (Thai, Lao, Myanmar, Khmer,
# kana, Han). Ranges, as classes of scripts cost a search per letter.
_UNSPACED = (r"฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿"
             r"\x{20000}-\x{3FFFF}")
_NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*"
_UNIT = rf"(?<=[0-9]{END})\x20?((?i:" + "|".join(UNITS) + r"))(?![\p{L}\p{M}\p{N}])"
_NAME = rf"(?<![\p{{L}}\p{{M}}{UNIT}])\p{{Lu}}[\p{{L}}\p{{M}}]*"
_TOKEN = (rf"[\p{{L}}\p{{M}}&&[^{_UNSPACED}]]++|[{NAME}-{UNIT}][^{END}]*+{END}"
          rf"|[{_UNSPACED}&&[\p{{L}}\p{{M}}]]\p{{M}}*+")


def tokens(text: Column) -> Column:
    """Words in lower case and slots in order; a slot is its type, its value in lower case and an end
    mark. Marks that stand in the text itself are dropped first."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{END}-{UNIT}]+", " ")
    numbered = F.regexp_replace(plain, _NUMBER, f"{NUMBER}$0{END}")
    whole = F.regexp_replace(numbered, _UNIT, f"{UNIT}$1{END}")
    named = F.regexp_replace(whole, _NAME, f"{NAME}$0{END}")
    return F.regexp_extract_all(F.lower(named), F.lit(_TOKEN), F.lit(0))


def _kind(token: Column) -> Column:
    return F.substring(token, 1, 1)


def _is_slot(token: Column, kind: str = NAME) -> Column:
    """Whether a token is a slot of this type or one behind it: strings compare by their first mark."""
    return (token >= kind) & (token < chr(ord(UNIT) + 1))


def _value(token: Column) -> Column:
    return F.translate(token, END + NAME + NUMBER + UNIT, "")


def _hashes(found: str) -> dict[str, Column]:
    """A hash per token: slots by type; names as words; everything by value."""
    named = F.transform(found, lambda t: F.xxhash64(F.when(_is_slot(t), _kind(t)).otherwise(t)))
    worded = F.transform(found, lambda t: F.xxhash64(
        F.when(~_is_slot(t), t).when(_is_slot(t, NUMBER), _kind(t)).otherwise(_value(t))))
    return {"named": named, "worded": worded, "valued": F.transform(found, lambda t: F.xxhash64(_value(t)))}


def _window(hashes: str, at: Column, length: int = WINDOW) -> Column:
    # a hash of columns passes over nulls: a shorter text is hashed as it is
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(length)])


def _item_windows(items: DataFrame) -> DataFrame:
    """item_id, item_key, n_windows, w, h, its, place, valued, length: the windows that count (w), every
    hash (h) by which one is met, and the slots (position, value) and place of its first occurrence."""
    found = items.select(
        "item_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("item_key"), tokens(F.col("text")).alias("t"))
    hashed = found.filter(F.size("t") > 0).withColumns(_hashes("t"))

    def window(at: Column) -> Column:
        five = F.slice("t", at + 1, WINDOW)
        words = F.size(F.filter(five, lambda t: ~_is_slot(t)))
        names = F.size(F.filter(five, lambda t: _kind(t) == NAME))
        valued = (F.size("t") < WINDOW) | (words + names == 0)
        by = F.when(valued, F.array(_window("valued", at))).when(
            words >= LEAST_WORDS, F.array(_window("named", at), _window("worded", at))).otherwise(
            F.array(_window("worded", at)))
        slots = F.transform(five, lambda t, i: F.struct(i.alias("i"), F.when(_is_slot(t), _value(t)).alias("v")))
        return F.struct(at.alias("at"), valued.alias("valued"), by.alias("by"),
                        F.filter(slots, lambda x: x["v"].isNotNull()).alias("its"))

    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size("t") - WINDOW, F.lit(0))), window)
    spoken = F.filter("each", lambda x: ~x["valued"])
    chosen = hashed.select("item_id", "item_key", F.least(F.size("t"), F.lit(WINDOW)).alias("length"), each.alias("each"))
    chosen = chosen.withColumn("each", F.when(F.size(spoken) > 0, spoken).otherwise(F.col("each")))
    n = F.size(F.array_distinct(F.transform("each", lambda x: F.get(x["by"], F.lit(0)))))
    rows = chosen.select("item_id", "item_key", "length", n.alias("n_windows"), F.inline_outer("each")).select(
        "*", F.get("by", F.lit(0)).alias("w"), F.explode_outer(F.array_distinct("by")).alias("h"))
    return rows.groupBy("item_id", "item_key", "n_windows", "w", "h", "valued", "length").agg(
        F.min_by("its", "at").alias("its"), F.min("at").alias("place"))


def _text_windows(lengths: list[int], values: bool) -> tuple[Column, dict[str, Column]]:
    """Windows of the tokens t, by slots and by words, and by value in the given lengths; and the columns
    that they are built from. With values, structs of place, hash and the values from there on;
    without, distinct hashes. A text without windows gives a null hash, which joins nothing: outer
    generators, as Spark would else filter by the size of what they take, and work it out anew for
    every window."""
    made = _hashes("t")
    if not lengths:
        del made["valued"]
    wanted = [("named", WINDOW), ("worded", WINDOW), *[("valued", n) for n in lengths]]

    def one(hashes: str, n: int) -> Column:
        def window(i: Column) -> Column:
            h = _window(hashes, i, n)
            return F.struct(i.alias("at"), h.alias("h"), F.slice("v", i + 1, n).alias("five")) if values else h

        return F.coalesce(F.when(F.size("t") >= n, F.transform(
            F.sequence(F.lit(0), F.size("t") - n), window)), F.array())

    every = F.concat(*[one(h, n) for h, n in wanted])
    if values:
        return F.inline_outer(every), made | {"v": F.transform("t", _value)}
    return F.explode_outer(F.array_distinct(every)).alias("h"), made


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, n_windows, n_found, n_slots, n_changed: the pairs that leak.

    n_windows: distinct windows of the item; n_found: those the document has with consistent slots;
    n_slots: distinct slot values of the item met; n_changed: those that have another value in the
    document. Null and empty texts, and those without letters and digits, have no tokens and leak
    nothing; an item of one to four tokens leaks wherever these stand one behind the other. Rows that
    repeat both id and text give one row per item; equal ids with different texts are told apart by
    text_key. Whole texts are read; only document keys and hashes of windows that the benchmark has
    are shuffled, and texts only of the documents that share four fifths of an item's windows.
    """
    items = benchmark.select("item_id", "text").distinct()
    theirs = saved(_item_windows(items), "benchmark-windows")
    # at most five numbers: the lengths in which values are compared
    lengths = sorted(r[0] for r in theirs.filter("valued").select("length").distinct().collect())
    keyed = docs.select("doc_id", text_key().alias("text_key"), "text")

    def exploded(rows: DataFrame, values: bool) -> DataFrame:
        column, made = _text_windows(lengths, values)
        found = rows.select("doc_id", "text_key", tokens(F.col("text")).alias("t"))
        return found.withColumns(made).select("doc_id", "text_key", column)

    pair = ["doc_id", "text_key", "item_id", "item_key"]
    hits = exploded(keyed, False).join(theirs.select("item_id", "item_key", "n_windows", "w", "h"), "h")
    # A row that repeats adds the same windows again: they are counted by their name.
    near = saved(
        hits.groupBy(*pair, "n_windows", "w").agg(F.lit(1).alias("one"))
        .groupBy(*pair, "n_windows").agg(F.count("*").alias("n"))
        .filter(F.col("n") * 10 >= F.col("n_windows") * SHARE_TENTHS).drop("n"), "near-items")

    wanted = near.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    # rows that repeat bring the same windows again, which changes no share and no majority
    mine = exploded(keyed.join(wanted, same, "left_semi"), True).join(theirs, "h")
    pairs = near.select(*[F.col(c).alias(f"__{c}") for c in pair])
    this = F.expr("doc_id <=> __doc_id and text_key = __text_key and item_id <=> __item_id and item_key = __item_key")
    against = F.transform("its", lambda x: F.struct(x["v"].alias("b"), F.get("five", x["i"]).alias("d")))
    met = saved(
        mine.select(*pair, "n_windows", (F.col("at") - F.col("place")).alias("shift"), "w", against.alias("s"))
        .join(pairs, this, "left_semi").distinct(), "met-windows")

    one = [*pair, "kind", "nth"]
    parts = saved(_occurrences(met, pair), "occurrences")
    votes = parts.select(*one, F.explode("s").alias("x")).groupBy(*one, "x.b", "x.d").count()
    first = Window.partitionBy(*one, "b").orderBy(F.desc("count"), F.desc(F.col("b") == F.col("d")), "d")
    chosen = votes.withColumn("r", F.row_number().over(first)).filter("r = 1")
    mapping = chosen.groupBy(*one).agg(
        F.map_from_entries(F.collect_list(F.struct("b", "d"))).alias("m"),  # at most the item's values
        F.count("*").alias("n_slots"), F.count_if(F.col("b") != F.col("d")).alias("n_changed"))
    left, right = parts.alias("l"), mapping.alias("r")
    agree = left.join(
        right, F.expr("l.doc_id <=> r.doc_id and l.text_key = r.text_key and l.item_id <=> r.item_id and "
                      "l.item_key = r.item_key and l.kind = r.kind and l.nth = r.nth"), "left")
    agree = agree.filter(F.forall("l.s", lambda x: F.try_element_at("r.m", x["b"]) == x["d"]))
    held = agree.groupBy(*[f"l.{c}" for c in one], "l.n_windows").agg(
        F.countDistinct("l.w").alias("n_found"), F.coalesce(F.max("r.n_slots"), F.lit(0)).alias("n_slots"),
        F.coalesce(F.max("r.n_changed"), F.lit(0)).alias("n_changed"))
    best = F.max(F.struct("n_found", (-F.col("n_changed")).alias("kept"), "n_slots", "n_changed"))
    return (
        held.filter(F.col("n_found") * 10 >= F.col("n_windows") * SHARE_TENTHS)
        .groupBy(*pair, "n_windows").agg(best.alias("x"))
        .select("doc_id", "text_key", "item_id", "n_windows", "x.n_found", "x.n_slots", "x.n_changed")
    )


def _occurrences(met: DataFrame, pair: list[str]) -> DataFrame:
    """The met windows three times over, by where the item may begin (kind, nth): all of the document,
    windows of equal shift against the item (a plain copy or version), and runs of shifts without a gap
    of more than half the item (a version with words put in or left out)."""
    before = F.lag("shift").over(Window.partitionBy(*pair).orderBy("shift"))
    new = F.coalesce((F.col("shift") - before) * 2 > F.col("n_windows"), F.lit(False)).cast("int")
    rows = Window.partitionBy(*pair).orderBy("shift").rowsBetween(Window.unboundedPreceding, 0)
    numbered = met.withColumn("new", new).withColumn("run", F.sum("new").over(rows))
    groups = [(0, F.lit(0)), (1, F.col("shift")), (2, F.col("run"))]
    each = F.array(*[F.struct(F.lit(k).alias("kind"), n.cast("long").alias("nth")) for k, n in groups])
    return numbered.select(*pair, "n_windows", "w", "s", F.inline(each))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that leak no item, with their columns. Null and empty texts stay; rows that
    repeat stay or go together."""
    found = saved(leaks(docs.select("doc_id", "text"), benchmark).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "leaking")
    return docs.join(
        found, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key")), "left_anti")

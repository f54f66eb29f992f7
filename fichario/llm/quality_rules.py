"""Quality rules whose cutoffs keep a promise: few good documents lost, per stratum, proven on labels.

Every rule is a per-mille measure of a text; a document goes if a measure is above its stratum's
cutoff. For each stratum and rule the cutoffs are tried from lenient to strict on the labelled
holdout. With n good documents of which k would go, a cutoff is certified if
P(Binomial(n, alpha / rules) <= k) <= delta / (strata x rules): the exact binomial bound on its false
rejections, corrected for all strata and rules; within one ladder the trials are a fixed sequence that
ends at the first failure and needs no correction. With probability 1 - delta no stratum loses more
than a share alpha of its good documents to all its rules together. Among certified cutoffs the one
that catches most poor documents, good ones weighing `weight` times as much, is taken; a stratum with
too few labels has none and loses nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fichario.llm.common import saved, words

RULES = ("symbols", "repeats", "dup_lines", "marks", "capitals")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 8
ALPHA, DELTA, WEIGHT = 0.02, 0.05, 10
BROADCAST_STRATA = 20_000


def repeated_words(hashes: Column) -> Column:
    """Words in windows of eight words that are found twice or more in the text.

    Windows are told apart by a 64-bit hash of the words' hashes.
    """
    n = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Spark binds one lambda per call, so that the sorted list is named by a lambda as well.
    twice = F.transform(
        F.array(placed),
        lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))[0]
    covered = F.transform(
        F.array(twice),
        lambda p: F.aggregate(
            F.transform(p, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))[0]
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(n < WINDOW, 0).when(some, covered).otherwise(0).cast("long")


def _count(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measured(docs: DataFrame, stratum: str) -> DataFrame:
    """__row (all columns of docs), stratum, the base counts and the rules' measures of every row.

    Null texts count as empty, null strata as one stratum of their own. A map over rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(
        F.struct("*").alias("__row"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        text.alias("__text"))
    split = whole.select(
        "__row", "stratum", "__text", words("__text").alias("__words"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"))
    hashed = split.select(
        "__row", "stratum", "__text", F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"))
    counted = hashed.select(
        "__row", "stratum", "n_words", "word_chars", "n_lines", "n_dup_lines",
        _count(F.col("__text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _count(F.col("__text"), r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("n_marks"),
        _count(F.col("__text"), r"[^\p{Lu}]+").alias("n_capitals"),
        repeated_words(F.col("__hashes")).alias("n_repeat_words"))

    def mille(part: str, all_: str) -> Column:
        return F.coalesce(F.floor(F.lit(1000) * F.col(part) / F.col(all_)), F.lit(0)).cast("int")

    nonzero = {c: F.when(F.col(c) > 0, F.col(c)) for c in ("word_chars", "n_words", "n_lines")}
    return counted.withColumns({f"__{c}": e for c, e in nonzero.items()}).select(
        "__row", "stratum", *BASE,
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        mille("n_symbols", "__word_chars").alias("symbols"),
        mille("n_repeat_words", "__n_words").alias("repeats"),
        mille("n_dup_lines", "__n_lines").alias("dup_lines"),
        mille("n_marks", "__word_chars").alias("marks"),
        mille("n_capitals", "__word_chars").alias("capitals"))


def log_gamma(x: Column) -> Column:
    """For x >= 1, by Stirling's series at x + 7."""
    y = x + 7
    low = sum((F.log(x + k) for k in range(1, 7)), F.log(x))
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - low


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k). Terms are added from k downwards; those beyond twelve deviations
    are below double precision. Where k is not under the mean the answer is at least about a half, and 1 is given."""
    n, k = n.cast("double"), k.cast("double")
    at_k = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
                 + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.sequence(F.lit(0), F.least(k, 60 + 12 * F.sqrt(n * p)).cast("int"))
    total = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda s, j: F.struct(
            (s["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("term"),
            (s["sum"] + s["term"]).alias("sum")))["sum"]
    return F.when(k >= n * p, 1.0).otherwise(at_k * total)


def cutoffs(
    holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA, weight: float = WEIGHT
) -> DataFrame:
    """stratum and one cutoff per rule (null: none certified) from holdout (stratum, rules, good).

    All labelled rows count. They are aggregated to (stratum, rule, value) first, at most 1,001
    values a rule; what follows works on those.
    """
    long = holdout.select(
        "stratum", "good", F.explode(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.least(F.col(r), F.lit(1000)).alias("value"))
            for r in RULES])).alias("x"))
    counts = saved(
        long.groupBy("stratum", "x.rule", "x.value").agg(
            F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("poor")), "rule-values")
    strata = max(1, counts.select("stratum").distinct().count())
    ladder = Window.partitionBy("stratum", "rule").orderBy(F.desc("value"))
    above, whole = ladder.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("stratum", "rule")
    tried = counts.select(
        "stratum", "rule", "value", F.coalesce(F.sum("good").over(above), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("poor").over(above), F.lit(0)).alias("caught"),
        F.sum("good").over(whole).alias("n_good"), F.sum("poor").over(whole).alias("n_poor"))
    level = delta / (strata * len(RULES))
    sure = binomial_tail(F.col("n_good"), F.col("lost"), alpha / len(RULES)) <= level
    gain = F.col("caught") / F.col("n_poor") - weight * F.col("lost") / F.col("n_good")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("value"))
    chosen = (
        tried.withColumn("sure", F.min(F.when(F.col("n_good") > 0, sure).otherwise(False)).over(
            ladder.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("sure and caught > 0").withColumn("gain", gain)
        .withColumn("r", F.row_number().over(best)).filter("r = 1 and gain > 0")
    )
    return saved(
        chosen.groupBy("stratum").agg(*[
            F.max(F.when(F.col("rule") == r, F.col("value"))).alias(f"max_{r}") for r in RULES]),
        "rule-cutoffs")


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """measures with the stratum's cutoffs and kept: not base_failed, no measure above its cutoff."""
    small = limits.count() <= BROADCAST_STRATA  # beyond that the strata are joined by shuffle
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False))
    return measures.join(F.broadcast(limits) if small else limits, "stratum", "left").withColumn(
        "kept", ~F.col("base_failed") & ~over)


def one_label(labels: DataFrame) -> DataFrame:
    """doc_id, good: documents with any label of poor quality are poor; null ids and labels go."""
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") > 0).alias("good"))


def certified(measures: DataFrame, labels: DataFrame, **promise) -> DataFrame:
    """Cutoffs from the labelled rows of measures (doc_id, stratum, rules, base_failed) that the base
    rules leave."""
    holdout = measures.filter("not base_failed").select("doc_id", "stratum", *RULES).join(
        one_label(labels), "doc_id")
    return cutoffs(holdout, **promise)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **promise) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, stratum, measures and cutoffs of every row of docs.

    Every text is measured once; what is saved and shuffled holds no text. Null and empty texts have
    no words and fail the base rules. Repeated rows are returned as often as they come. Without labels
    only the base rules reject. An empty table gives no rows.
    """
    measures = saved(
        measured(docs.select("doc_id", "text", stratum), stratum).select(
            F.col("__row.doc_id").alias("doc_id"), "stratum", *BASE, "base_failed", *RULES), "measures")
    limits = certified(measures, labels, **promise)
    columns = [*BASE, "base_failed", "kept", "stratum", *RULES, *[f"max_{r}" for r in RULES]]
    return judged(measures, limits).select("doc_id", *columns)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **promise) -> DataFrame:
    """The rows of docs that the rules keep, with their columns. The cutoffs come from the measures of
    the labelled rows, joined without texts; then every row is measured again and judged where it
    lies, so that no text is ever shuffled."""
    measures = measured(docs.select("doc_id", "text", stratum), stratum).select(
        F.col("__row.doc_id").alias("doc_id"), "stratum", *RULES, "base_failed")
    limits = certified(saved(measures, "measures"), labels, **promise)
    # The generator keeps the filter above the measures: pushed below, it would repeat them for every rule.
    measures = measured(docs, stratum).select(
        "__row", F.inline(F.array(F.struct("stratum", *RULES, "base_failed"))))
    return judged(measures, limits).filter("kept").select("__row.*")


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
q AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 7], ' ')) AS c FROM p),
v AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM q, range(8) AS x(j) WHERE c > 1 GROUP BY r),
b AS (
  SELECT r, doc_id, stratum, CAST(len(ws) AS bigint) AS n_words, CAST(length(array_to_string(ws, '')) AS bigint) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines, len(ls) AS n_lines,
    CAST(coalesce(n_repeat_words, 0) AS bigint) AS n_repeat_words,
    length(regexp_replace(t, '[\\p{{L}}\\p{{N}}\\x20\\x09-\\x0D]', '', 'g')) AS n_marks,
    length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN v USING (r)),
m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CAST(coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS int) AS symbols,
    CAST(coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS int) AS repeats,
    CAST(coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS int) AS dup_lines,
    CAST(coalesce(1000 * n_marks // nullif(word_chars, 0), 0) AS int) AS marks,
    CAST(coalesce(1000 * n_capitals // nullif(word_chars, 0), 0) AS int) AS capitals FROM b),
g AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
l AS (
  {' UNION ALL '.join(f"SELECT stratum, '{r}' AS rule, least({r}, 1000) AS value, good FROM m JOIN g USING (doc_id) WHERE NOT base_failed" for r in RULES)}),
c AS (
  SELECT stratum, rule, value, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS poor
  FROM l GROUP BY ALL),
s AS (
  SELECT stratum, rule, value, coalesce(sum(good) OVER a, 0) AS lost, coalesce(sum(poor) OVER a, 0) AS caught,
    sum(good) OVER (PARTITION BY stratum, rule) AS n_good, sum(poor) OVER (PARTITION BY stratum, rule) AS n_poor
  FROM c WINDOW a AS (PARTITION BY stratum, rule ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT greatest(1, count(DISTINCT stratum)) AS strata FROM c),
z AS (
  SELECT *, n_good > 0 AND lost < n_good * {ALPHA / len(RULES)} AND coalesce(list_sum(list_transform(
      range(0, CAST(lost AS bigint) + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
        + i * ln({ALPHA / len(RULES)}) + (n_good - i) * ln(1 - {ALPHA / len(RULES)})))), 1)
      <= {DELTA} / (strata * {len(RULES)}) AS sure,
    caught / nullif(n_poor, 0) - {WEIGHT} * lost / nullif(n_good, 0) AS gain FROM s, k),
y AS (
  SELECT *, min(CASE WHEN sure THEN 1 ELSE 0 END) OVER (
    PARTITION BY stratum, rule ORDER BY value DESC ROWS UNBOUNDED PRECEDING) AS all_sure FROM z),
x AS (
  SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, value DESC) AS n
  FROM y WHERE all_sure = 1 AND caught > 0),
f AS (
  SELECT stratum, {', '.join(f"max(value) FILTER (WHERE rule = '{r}') AS max_{r}" for r in RULES)}
  FROM x WHERE n = 1 AND gain > 0 GROUP BY stratum)
SELECT doc_id, {', '.join(BASE)}, base_failed,
  NOT base_failed AND NOT ({' OR '.join(f'coalesce({r} > max_{r}, false)' for r in RULES)}) AS kept,
  stratum, {', '.join(RULES)}, {', '.join(f'max_{r}' for r in RULES)}
FROM m LEFT JOIN f USING (stratum)
"""

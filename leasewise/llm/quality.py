"""Quality rules whose thresholds come from quantile sketches of each language and source.

All on DataFrame functions.  A sketch is a histogram of integer buckets: exact
below 64, then 32 buckets for each power of two, so a bucket is within 1/32 of
its values.  Sketches merge by adding counts and do not depend on the order of
rows or tasks, and a group's sketch has a bounded number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import cut
from .common import WORD, named_back, numbered

SPACE = r"[\x20\x09-\x0D]+"
GRAM = 5  # words of a repeated window
NONE = "\u0000"  # stands for a null language or source


@dataclass(frozen=True)
class Rule:
    """A measure and how far it may lie from its group's middle half.

    A row fails above q75 + reach * spread, and with `both` also below q25 -
    reach * spread; the spread is q75 - q25, `least` at the smallest, so that
    a group of nearly equal rows does not reject the next one.
    """
    name: str
    top: str  # the measure is scale * top / bottom, rounded down
    bottom: str
    scale: int
    least: int
    reach: int = 3
    both: bool = False


RULES = (
    Rule("word_length", "word_chars", "n_words", 100, 100, both=True),
    Rule("symbols", "n_symbols", "n_words", 1000, 60),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1000, 100),
    Rule("repeats", "n_repeat_words", "n_words", 1000, 50),
)
LEAST_WORDS = 10
MOST_REPEATS = 20  # per cent of the words
LEAST_ROWS = 50  # rows a group needs for thresholds of its own


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns plus `_base`, a struct of counts over the whole text.

    Windows of five words are compared by a 64-bit hash within one text.
    """
    columns = [docs[c] for c in docs.columns]
    body = F.coalesce(docs[text], F.lit(""))
    split = docs.select(
        *columns, body.alias("_body"), F.array_remove(F.split(body, SPACE), "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias("_lines"))
    keep = docs.columns
    hashed = split.select(*keep, "_body", "_words", "_lines", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hash"))
    grams = hashed.select(*keep, "_body", "_words", "_lines", F.when(F.size("_hash") > GRAM, F.transform(
        F.sequence(F.lit(0), F.size("_hash") - GRAM),
        lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(GRAM)]))).alias("_grams"))
    # Places of windows found twice or more: equal neighbours after sorting.
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = grams.withColumn("_sorted", F.when(repeated, F.sort_array(F.transform(
        "_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    same = lambda a, b: F.coalesce(a["g"] == b["g"], F.lit(False))
    twice = placed.withColumn("_at", F.sort_array(F.transform(
        F.filter("_sorted", lambda e, i: same(e, F.get("_sorted", i - 1)) | same(e, F.get("_sorted", i + 1))), lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda x, i: F.least(F.lit(GRAM), F.coalesce(F.get("_at", i + 1) - x, F.lit(GRAM)))),
        F.lit(0), lambda total, x: total + x)
    counts = {
        "n_words": F.size("_words"), "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_body", F.lit(r"[#*$%&|<>]")),
        "n_lines": F.size("_lines"), "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0))}
    return twice.select(*keep, F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]).alias("_base"))


def _bucket(v: Column) -> Column:
    over = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return over * 32 + F.call_function("shiftright", v, over)


def _edges(code: Column) -> tuple[Column, Column]:
    """Smallest and largest value of a bucket."""
    over = F.greatest(F.floor(code / 32) - 1, F.lit(0)).cast("int")
    low = F.call_function("shiftleft", (code - over * 32).cast("long"), over)
    return low, low + F.call_function("shiftleft", F.lit(1).cast("long"), over) - 1


def _measures(base: Column) -> list[Column]:
    return [F.when(base[r.bottom] > 0, F.floor(base[r.top] * r.scale / base[r.bottom])).otherwise(0).cast("long") for r in RULES]


def sketches(measured_docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(level, lang, source, rule, code, n): merged sketches of each source in a language, each language, and all."""
    keyed = measured_docs.filter(F.col("_base.n_words") > 0).select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NONE)).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit(NONE)).alias("source"),
        F.posexplode(F.array(*_measures(F.col("_base")))).alias("rule", "value"))
    fine = keyed.groupBy("lang", "source", "rule", _bucket(F.col("value")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    merged = fine.groupingSets([["lang", "source", "rule", "code"], ["lang", "rule", "code"], ["rule", "code"]],
                               "lang", "source", "rule", "code").agg(F.sum("n").alias("n"), F.grouping_id().alias("_gid"))
    level = F.when(F.col("_gid") == 0, 0).when(F.col("lang").isNotNull(), 1).otherwise(2)
    return merged.select(level.alias("level"), "lang", "source", "rule", "code", "n")


def fences(sketch: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, low, high): arrays with the limits of each rule, for every group seen.

    A group with fewer than `least_rows` rows takes its language's limits, or
    those of all rows where the language has too few.
    """
    group = ["level", "lang", "source", "rule"]
    along = Window.partitionBy(*group).orderBy("code")  # the buckets of one sketch
    summed = sketch.withColumn("_sum", F.sum("n").over(along)).withColumn("_all", F.sum("n").over(Window.partitionBy(*group)))
    quarter = lambda k: F.min(F.when(F.col("_sum") * 4 >= F.col("_all") * k, F.col("code")))
    rows = summed.groupBy(*group).agg(quarter(1).alias("_a"), quarter(3).alias("_b"), F.max("_all").alias("n"))
    q25, q75 = _edges(F.col("_a"))[0], _edges(F.col("_b"))[1]
    of_rule = lambda f: F.element_at(F.array(*[F.lit(f(r)) for r in RULES]), F.col("rule") + 1)
    spread = F.greatest(q75 - q25, of_rule(lambda r: r.least)) * of_rule(lambda r: r.reach)
    rows = rows.withColumn("low", F.when(of_rule(lambda r: r.both), q25 - spread).otherwise(F.lit(0)).cast("long")).withColumn("high", (q75 + spread).cast("long"))
    limit = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("rule", c))), lambda x: x[c])  # noqa: E731  one row a rule
    each = rows.groupBy("level", "lang", "source").agg(limit("low").alias("low"), limit("high").alias("high"), F.max("n").alias("n"))
    own, by_lang, every = (each.filter(F.col("level") == k) for k in range(3))
    pick = lambda c: F.when(F.col("n") >= least_rows, F.col(c)).when(F.col("_ln") >= least_rows, F.col(f"_l{c}")).otherwise(F.col(f"_a{c}"))
    return (
        own.join(by_lang.select("lang", F.col("low").alias("_llow"), F.col("high").alias("_lhigh"), F.col("n").alias("_ln")), "lang")
        .crossJoin(F.broadcast(every.select(F.col("low").alias("_alow"), F.col("high").alias("_ahigh"))))  # one row
        .select("lang", "source", pick("low").alias("low"), pick("high").alias("high")))


def judged(measured_docs: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """All columns plus `_base`, `_failed` (fixed rules) and `_kept` (the whole verdict)."""
    base = F.col("_base")
    failed = (base["n_words"] < LEAST_WORDS) | (base["n_repeat_words"] * 100 > base["n_words"] * MOST_REPEATS)
    named = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    left = measured_docs.withColumns({"_lang": F.coalesce(F.col(lang).cast("string"), F.lit(NONE)),
                                      "_source": F.coalesce(F.col(source).cast("string"), F.lit(NONE))})
    inside = F.lit(True)
    for i, m in enumerate(_measures(base)):
        inside = inside & F.coalesce((m >= F.col("_low")[i]) & (m <= F.col("_high")[i]), F.lit(True))
    return left.join(named, ["_lang", "_source"], "left").withColumn("_failed", failed).withColumn("_kept", ~F.col("_failed") & inside).drop("_low", "_high", "_lang", "_source")


def quality_verdicts(docs: DataFrame, keep: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: its id, the counts, base_failed and kept.

    A null or empty text has no words and fails; null languages and sources
    are groups of their own; repeated rows are judged each; other columns are
    not read.  The counts are written once and serve the sketches and the
    verdicts.
    """
    narrow = docs.select(docs[keep].alias("_id"), docs[text].alias("_text"), docs[lang].alias("_l"), docs[source].alias("_s"))
    counted = cut(measured(narrow, "_text").drop("_text"))
    done = judged(counted, cut(fences(sketches(counted, "_l", "_s"))), "_l", "_s")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return done.select(F.col("_id").alias(keep), *[F.col(f"_base.{n}").alias(n) for n in names], F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that pass, with the columns they came with.

    The rows and their counts are written once: the limits come from all
    rows, and the rows meet them in a join on language and source, which is a
    broadcast while the limits are small.
    """
    rows, (text, lang, source) = numbered(docs, text, lang, source)
    counted = cut(measured(rows, text))
    limits = cut(fences(sketches(counted, lang, source)))  # written, so that its size is known to the join
    return named_back(judged(counted, limits, lang, source).filter("_kept"), docs.columns)


def _sql_measure(r: Rule) -> str:
    return f"CASE WHEN {r.bottom} > 0 THEN {r.top} * {r.scale} // {r.bottom} ELSE 0 END"


SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, words[i:i + {GRAM - 1}] AS g FROM (SELECT r, words, unnest(range(1, len(words) - {GRAM - 2})) AS i FROM split WHERE len(words) > {GRAM})),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT r, sum(least({GRAM}, coalesce(nxt - i, {GRAM}))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
base AS (
  SELECT r, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered c USING (r)),
measures AS ({" UNION ALL ".join(f"SELECT r, lang, source, {k} AS rule, {_sql_measure(rule)} AS v FROM base WHERE n_words > 0" for k, rule in enumerate(RULES))}),
levels AS (
  SELECT 0 AS level, lang, source, rule, v FROM measures UNION ALL SELECT 1, lang, '', rule, v FROM measures
  UNION ALL SELECT 2, '', '', rule, v FROM measures),
ranked AS (
  SELECT level, lang, source, rule, v, count(*) OVER g AS n, row_number() OVER (g ORDER BY v) AS k FROM levels WINDOW g AS (PARTITION BY level, lang, source, rule)),
quarters AS (
  SELECT level, lang, source, rule, max(n) AS n, min(v) FILTER (k * 4 >= n) AS a, min(v) FILTER (k * 4 >= n * 3) AS b FROM ranked GROUP BY ALL),
edges AS (
  SELECT level, lang, source, rule, n, (a >> ea) << ea AS q25, (((b >> eb) + 1) << eb) - 1 AS q75
  FROM (SELECT *, greatest(length(bin(a)) - 6, 0) AS ea, greatest(length(bin(b)) - 6, 0) AS eb FROM quarters)),
reach (rule, least, reach, both_ends) AS (VALUES {", ".join(f"({k}, {r.least}, {r.reach}, {str(r.both).lower()})" for k, r in enumerate(RULES))}),
limits AS (
  SELECT level, lang, source, rule, n, CASE WHEN both_ends THEN q25 - reach * greatest(q75 - q25, least) ELSE 0 END AS low,
    q75 + reach * greatest(q75 - q25, least) AS high FROM edges JOIN reach USING (rule)),
outside AS (
  SELECT DISTINCT m.r FROM measures m
  JOIN limits o ON o.level = 0 AND o.lang = m.lang AND o.source = m.source AND o.rule = m.rule
  JOIN limits l ON l.level = 1 AND l.lang = m.lang AND l.rule = m.rule JOIN limits e ON e.level = 2 AND e.rule = m.rule
  WHERE m.v < CASE WHEN o.n >= {LEAST_ROWS} THEN o.low WHEN l.n >= {LEAST_ROWS} THEN l.low ELSE e.low END
     OR m.v > CASE WHEN o.n >= {LEAST_ROWS} THEN o.high WHEN l.n >= {LEAST_ROWS} THEN l.high ELSE e.high END)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATS} AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATS}) AND o.r IS NULL AS kept
FROM base LEFT JOIN outside o USING (r)
"""

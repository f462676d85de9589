"""Resampling towards a target: array-scored weights, an exact cutoff by bisection, ranks by range.

Features of all documents and of a target text are hashed to buckets; a
document's weight is the mean gain of its buckets, read from one array.  The
best scores are then drawn without a global sort: exact counts over the written
scores close in on the cutoff, and only rows beyond it are put in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import numbered_all
from ..session import cut
from .common import by_text

BUCKETS = 10_000
SCALE = 1000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
WAYS = 16  # parts into which one count job cuts the range that holds the cutoff

# Digits and small letters stay, A to Z become small, bytes of other characters stay, all else parts the words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_SIGNS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all words and pairs of words in a row of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_SIGNS).split()
    single = [crc32(w) for w in words]
    double = [crc32(b" " + w, c) for w, c in zip(words[1:], single)]
    return np.array(single + double, np.int64) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: each task hands on one count a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                sums += np.bincount(feature_buckets(value.as_py(), buckets), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(sums[at], pa.int64())})

    counts = np.zeros(buckets, np.int64)
    counted = texts.select(texts[text].alias("text")).mapInArrow(run, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """What a feature of each bucket adds: the scaled log of its share in the target over its share in the source."""
    ratio = (target + 1.0) * (source.sum() + float(len(source))) / ((source + 1.0) * (target.sum() + float(len(source))))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def nth_largest(rows: DataFrame, value: str, n: int, ways: int = WAYS) -> int:
    """The n-th largest of a whole-number column (1 to its non-null rows), by counts alone.

    Each job counts the rows at or above each of `ways` - 1 thresholds and
    leaves the part of the range where the count passes n; two ways are plain
    bisection.  Only counts reach the driver.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = max(1, (high - low) // ways)
        marks = [m for m in range(low + step, high + 1, step)][:ways]
        counts = rows.agg(*[F.count(F.when(F.col(value) >= F.lit(m), 1)) for m in marks]).first()
        reached = sum(c >= n for c in counts)  # counts fall as marks rise
        low, high = marks[reached - 1] if reached else low, marks[reached] - 1 if reached < len(marks) else high
    return low


def drawn(scored: DataFrame, score: str, key: str, eligible: Column, n: int, ways: int = WAYS) -> Column:
    """A condition for the `n` eligible rows of highest score, ties to the smaller key, null keys last.

    Rows that share score and key with the last one drawn all meet it.
    """
    able = scored.filter(eligible)
    least = nth_largest(able, score, n, ways)
    tied = able.filter(F.col(score) == least).withColumn("_turned", F.bitwise_not(F.col(key).cast("long")))
    above, solid = able.agg(F.count(F.when(F.col(score) > least, 1))).first()[0], tied.filter("_turned is not null").count()
    if n - above > solid:
        return eligible & (F.col(score) >= least)
    last = ~nth_largest(tied, "_turned", n - above, ways)
    return eligible & ((F.col(score) > least) | ((F.col(score) == least) & (F.col(key) <= last)))


def resampled(docs: DataFrame, target: DataFrame, keep: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
              least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, ways: int = WAYS) -> DataFrame:
    """(keep, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    Score is the weight plus noise from a hash of the id.  Of the documents
    with `least_words` words or more, floor(percent / 100) of them are drawn:
    the highest scores, ties to the smaller id (an integer), null ids last.
    Null and empty texts have no features and weight 0.  Repeated rows are rows
    of their own with equal scores and successive ranks; where only some of
    them can be drawn, any are.  An empty table gives no rows, an empty target
    equal gains for all but the source's own counts.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))

    def weigh(texts: list[str | None]) -> dict[str, pa.Array]:
        found = [feature_buckets(t, buckets) for t in texts]
        return {"n_features": pa.array([len(f) for f in found], pa.int64()),
                "weight": pa.array([int(gain[f].sum()) // len(f) if len(f) else 0 for f in found], pa.int64())}

    named = docs.select(docs[keep].alias("id"), docs[text].alias("text"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(by_text(named, ["id"], "text", "n_features long, weight long", weigh).withColumns(
        {"score": (F.col("weight") + noise).cast("long"), "_row": F.monotonically_increasing_id()}))
    eligible = F.col("n_features") >= max(2 * least_words - 1, 0)  # n words have 2 n - 1 features
    n = scored.filter(eligible).count() * percent // 100
    columns = [F.col("id").alias(keep), "n_features", "weight", "score"]
    if not n:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen = drawn(scored, "score", "id", eligible, n, ways)
    # The written row number ends the order, so rows of one id can be spread as well.
    ranked = numbered_all(scored.filter(chosen), [F.desc("score"), F.col("id").asc_nulls_last(), F.col("_row")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    rest = scored.filter(~F.coalesce(chosen, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns, "rank").unionByName(rest.select(*columns, "rank"))


SQL = r"""
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
counted AS (SELECT side, id, f, count(*) AS n FROM features GROUP BY side, id, f),
names AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM counted),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2), lambda i:
      16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM names, steps),
placed AS (SELECT side, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY side, id, bucket),
sums AS (
  SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(sums.t, 0)::double + 1) * (totals.s::double + 10000)
    / ((coalesce(sums.s, 0)::double + 1) * (totals.t::double + 10000))))::bigint AS gain FROM sums, totals),
weights AS (
  SELECT id, sum(n)::bigint AS n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::bigint::double + 0.5) / 4294967296)))::bigint AS score
  FROM (SELECT row_number() OVER () AS id, doc_id FROM documents) d LEFT JOIN weights USING (id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 25 * count(*) OVER () // 100 AS n FROM scored WHERE n_features >= 39)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

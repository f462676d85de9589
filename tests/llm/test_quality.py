import re
from collections import Counter

from compare import connect, difference

import awkward
from conftest import rows
from leasewise.llm import quality


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_on_rows_of_any_kind(spark):
    extra = [(100 + i, t, "en", "s", 1, *awkward.DOCS[1][5:]) for i, t in enumerate(
        ["a b c d e a b c d e f", "x\ny\nx\n\n\nx", "a a a a a a a", "p q r s t u p q r s t v p q r s t", "\n\n", "# * $ % & | < >"])]
    got = rows(quality.quality_verdicts(awkward.docs(spark, awkward.DOCS + extra)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in awkward.DOCS + extra:
        c = plain_counts(r[1])
        want.append((r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert got == sorted(want, key=str)
    assert quality.quality_verdicts(awkward.empty(spark)).count() == 0
    assert quality.keep_good(awkward.empty(spark)).count() == 0


def test_limits_follow_the_group(spark):
    """The same text is kept where such texts are usual and rejected where they are not."""
    words = lambda n, k: " ".join(chr(97 + (i * 7 + k) % 26) * n + str(i * k) for i in range(40))
    short = [(i, words(3, i + 1), "en", "plain") for i in range(200)]
    long = [(1000 + i, words(30, i + 1), "en", "chemistry") for i in range(200)]
    odd = [(2000, words(30, 500), "en", "plain"), (2001, words(30, 500), "en", "chemistry")]
    docs = spark.createDataFrame(short + long + odd, "doc_id long, text string, lang string, source string")
    dropped = {r.doc_id for r in quality.quality_verdicts(docs).filter("not kept").collect()}
    assert dropped == {2000}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {r[0] for r in short + long + odd} - {2000}


def test_sketches_merge_in_any_partitioning(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 90 + 1) + "#" * (i % 300), "en", f"s{i % 3}") for i in range(600)], "doc_id long, text string, lang string, source string")
    one, many = (rows(quality.sketches(quality.measured(docs.repartition(n)))) for n in (1, 7))
    assert one == many


def test_bucket_edges(spark):
    from pyspark.sql import functions as F
    got = spark.range(5000).select("id", quality._bucket(F.col("id")).alias("c")).select("id", *[e.alias(n) for e, n in zip(quality._edges(F.col("c")), ("low", "high"))]).collect()
    assert all(r.low <= r.id <= r.high and (r.high - r.low) * 32 <= max(r.low, 1) * 1.0 + 31 for r in got)
    assert all(r.low == r.high == r.id for r in got if r.id < 64)


def test_same_as_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert difference(quality.quality_verdicts(docs), connect(sf_dir), quality.SQL) is None

import numpy as np
import pytest
from pyspark.sql import functions as F

import awkward
from conftest import rows
from leasewise.llm import mixing


def plain_rake(cells, want, rounds=2000):
    """Textbook fitting on a dict of cells; want: one dict of target shares for each position."""
    total = sum(cells.values())
    w = dict(cells)
    for _ in range(rounds):
        for k, shares in enumerate(want):
            for name, share in shares.items():
                have = sum(v for c, v in w.items() if c[k] == name)
                if have:
                    for c in w:
                        if c[k] == name:
                            w[c] *= share * total / have
    return {c: w[c] / cells[c] for c in cells}


def cells(seed):
    draw = np.random.default_rng(seed)
    return {(f"s{s}", f"l{a}", f"t{t}"): int(draw.integers(1, 1000) * (20 if s == 0 else 1)) for s in range(9) for a in range(3) for t in range(4) if draw.random() < 0.8}


def shares(cells, k):
    own = {}
    for c, n in cells.items():
        own[c[k]] = own.get(c[k], 0) + n
    return mixing.tempered(own)


@pytest.mark.parametrize("seed", [1, 2])
def test_factors_are_those_of_plain_fitting(spark, seed):
    table = cells(seed)
    frame = spark.createDataFrame([(*c, n) for c, n in table.items()], "source string, lang string, topic string, tokens long")
    got = {tuple(r[:3]): r[4] for r in rows(mixing.rake(frame, tolerance=1e-10))}
    want = plain_rake(table, [shares(table, k) for k in range(3)])
    assert got.keys() == want.keys()
    assert all(abs(got[c] - want[c]) < 1e-5 * max(1, want[c]) for c in want)


def test_given_targets(spark):
    table = cells(3)
    frame = spark.createDataFrame([(*c, n) for c, n in table.items()], "source string, lang string, topic string, tokens long")
    sources = spark.createDataFrame([(f"s{s}", 1.0) for s in range(9)], "source string, share double")
    done = mixing.rake(frame, {"l0": 0.5, "l1": 0.25, "l2": 0.25}, None, sources).withColumn("w", F.col("tokens") * F.col("factor"))
    total = sum(table.values())
    by = {r.lang: r.w / total for r in done.groupBy("lang").agg(F.sum("w").alias("w")).collect()}
    assert abs(by["l0"] - 0.5) < 1e-3 and abs(by["l1"] - 0.25) < 1e-3
    assert all(abs(r.w / total - 1 / 9) < 1e-3 for r in done.groupBy("source").agg(F.sum("w").alias("w")).collect())


def test_targets_without_a_fit(spark):
    """Each source has a language of its own, but the shares asked for differ."""
    frame = spark.createDataFrame([("a", "x", "t", 30), ("b", "y", "t", 70)], "source string, lang string, topic string, tokens long")
    halves = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double")
    with pytest.warns(UserWarning, match="not converged"):
        done = mixing.rake(frame, {"x": 0.9, "y": 0.1}, None, halves, rounds=3)
    assert {r.source: round(r.tokens * r.factor, 6) for r in done.collect()} == {"a": 50.0, "b": 50.0}
    with pytest.raises(ValueError, match="40.00%"):
        mixing.rake(frame, {"x": 0.9, "y": 0.1}, None, halves, rounds=3, strict=True)


def test_sample_has_the_calibrated_mix(spark):
    made = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 5 == 0, "fr").otherwise("en").alias("lang"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    got = mixing.sampled(made, topic=F.when(F.length("text") % 2 == 0, "even").otherwise("odd"), share=0.3)
    assert got.agg(F.max("mix_probability")).first()[0] < 1
    total = got.agg(F.sum("mix_tokens")).first()[0]
    tokens = {r.lang: r.n for r in made.groupBy("lang").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    want = mixing.tempered(tokens)
    for r in got.groupBy("lang").agg(F.sum("mix_tokens").alias("n")).collect():
        assert abs(r.n / total - want[r.lang]) < 0.02
    assert abs(total / sum(tokens.values()) - 0.3) < 0.02
    again = mixing.sampled(made.repartition(7), topic=F.when(F.length("text") % 2 == 0, "even").otherwise("odd"), share=0.3)
    exact = lambda df: rows(df.drop("mix_weight", "mix_probability"))  # noqa: E731  factors are sums of doubles
    assert exact(got) == exact(again)


@pytest.mark.parametrize("share", [mixing.SHARE, 2.5])
def test_sample_has_the_targets_under_strong_skew(spark, share):
    made = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("a b c "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 100 < 2, "rare").otherwise("en").alias("lang"), F.when(F.col("id") % 97 == 0, "few").otherwise("many").alias("source"))
    topic = F.when(F.col("doc_id") % 89 == 0, "odd").otherwise("even")
    got = mixing.sampled(made, topic=topic, share=share)
    copies = got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("mix_copies").alias("low"), F.max("mix_copies").alias("high"), F.max("mix_probability").alias("p"))
    assert copies.filter("n != low or n != high or n > p + 1 or n < floor(p)").count() == 0
    labels = made.withColumn("mix_topic", topic)
    assert got.agg(F.max("mix_probability")).first()[0] > 2  # no draw without repeats can have this mix
    total = got.agg(F.sum("mix_tokens")).first()[0]
    assert abs(total / 80_000 - share) < 0.02
    cells = labels.groupBy("source", "lang", "mix_topic").count().collect()
    expected = {tuple(r[:3]): r[3] for r in got.select("source", "lang", "mix_topic", "mix_probability").distinct().collect()}
    for label in ("source", "lang", "mix_topic"):
        want = mixing.tempered({r[0]: r[1] for r in labels.groupBy(label).count().collect()})
        for name, share in want.items():
            weight = sum(r[3] * expected[tuple(r[:3])] for r in cells if r[label] == name) / sum(r[3] * expected[tuple(r[:3])] for r in cells)
            drawn = got.filter(F.col(label) == name).agg(F.sum("mix_tokens")).first()[0] / total
            assert abs(weight - share) < 1e-3 and abs(drawn - share) < 0.02


def test_rows_of_any_kind(spark):
    docs = awkward.docs(spark)
    everything = mixing.sampled(docs, share=500.0)
    assert everything.columns == [*docs.columns, "mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_copies"]
    assert everything.filter("mix_probability < 1").count() == 0
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    assert ids(everything) == {r[0] for r in awkward.DOCS if (r[1] or "").split()}  # no word, no weight
    whole = everything.groupBy("doc_id", "text").agg(F.sum(1 / F.col("mix_copies")).alias("rows"))
    assert abs(whole.agg(F.sum("rows")).first()[0] - sum(bool((r[1] or "").split()) for r in awkward.DOCS)) < 1e-6
    assert mixing.sampled(awkward.empty(spark)).count() == 0
    assert mixing.sampled(everything).columns == everything.columns


def test_topics(spark):
    texts = ["a | b | c | d", "Licensed under X", "write to a.b@mail.example", "a### b### c###", "plain words"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.topic_of(F.col("text")).alias("t")).collect()
    assert [r.t for r in got] == ["table", "licensed", "contact", "marked", "prose"]

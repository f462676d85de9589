"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

The token weights of (source, language, topic) cells are raked to the target
shares of all three.  Languages and topics are few and known; sources may be
many, so their factors stay in a table and only sums by language and topic
come to the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .common import WORD

NONE = "\u0000"  # stands for a null label
ALPHA = 0.5  # default targets: shares of tokens to this power
SHARE = 0.5  # expected share of all tokens in the sample
MOST_LABELS = 10_000  # language x topic pairs that the driver holds
ROUNDS = 50
TOLERANCE = 1e-5


def _times(text: Column, part: str) -> Column:
    """How often `part` stands in the text, without overlaps."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def topic_of(text: Column) -> Column:
    """A coarse topic from the whole text: the first of these that applies."""
    low = F.lower(text)
    license_ = reduce(or_, [low.contains(f"licen{c}e{d} under") for c in "sc" for d in ("", "d")] + [low.contains(f"under the mit licen{c}e") for c in "sc"])
    marks = reduce(add, [_times(text, sign * 3) for sign in "#*$%&"])
    return (
        F.when(_times(text, " | ") >= 3, "table")
        .when(license_, "licensed")
        .when(text.contains("@") & text.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\."), "contact")
        .when(marks >= 3, "marked")
        .otherwise("prose"))


def labelled(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None) -> DataFrame:
    """All columns plus `_mix`: tokens (white-space words of the whole text), source, lang, topic."""
    body = F.coalesce(docs[text], F.lit(""))
    label = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return docs.withColumn("_mix", F.struct(
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("tokens"), label(docs[source]).alias("source"), label(docs[lang]).alias("lang"),
        label(topic if topic is not None else topic_of(body)).alias("topic")))


def cells(labelled_docs: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens): sums over all documents with a token."""
    return labelled_docs.select("_mix.*").filter("tokens > 0").groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))


def tempered(totals: Mapping[str, float], alpha: float = ALPHA) -> dict[str, float]:
    powered = {k: v ** alpha for k, v in totals.items()}
    return {k: v / sum(powered.values()) for k, v in powered.items()}


def rake(table: DataFrame, lang_shares: Mapping[str, float] | None = None, topic_shares: Mapping[str, float] | None = None,
         source_shares: DataFrame | None = None, alpha: float = ALPHA, rounds: int = ROUNDS, tolerance: float = TOLERANCE, strict: bool = False) -> DataFrame:
    """(source, lang, topic, tokens, factor): tokens * factor has the target shares and the tokens' sum.

    `table` is a table of cells.  Targets without a given value are tempered
    token shares.  A round fits the sources (in Spark, from sums by source)
    and then languages and topics (on the driver, from sums by both).  Labels
    without tokens cannot be reached and their target goes to the others.
    Targets that contradict each other (a language of one source only, say, with
    another share than that source) have no fit: sources then have their
    shares, languages and topics come as near as `rounds` rounds bring them, and
    a warning tells how far off they are, or, if `strict`, a ValueError.
    """
    sums = table.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens")).limit(MOST_LABELS + 1).collect()
    if len(sums) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} pairs of language and topic; use coarser labels")
    if not sums:
        return table.withColumn("factor", F.lit(1.0))
    langs, topics = sorted({r["lang"] for r in sums}), sorted({r["topic"] for r in sums})
    total = float(sum(r["tokens"] for r in sums))

    def targets(names: list[str], given: Mapping[str, float] | None, key: str) -> np.ndarray:
        own: dict[str, float] = {n: 0.0 for n in names}
        for r in sums:
            own[r[key]] += r["tokens"]
        shares = tempered(own, alpha) if given is None else {n: float(given.get(n, 0.0)) for n in names}
        return np.array([shares[n] for n in names]) / (sum(shares.values()) or 1.0) * total

    want_lang, want_topic = targets(langs, lang_shares, "lang"), targets(topics, topic_shares, "topic")
    by_source = table.groupBy("source").agg(F.sum("tokens").alias("_t"))
    by_source = by_source.withColumn("_s", F.pow("_t", F.lit(alpha))) if source_shares is None else by_source.join(
        source_shares.select("source", F.col("share").cast("double").alias("_s")), "source")
    scale = total / (by_source.agg(F.sum("_s")).first()[0] or 1.0)
    wanted = by_source.select("source", (F.col("_s") * scale).alias("_want"))
    table = cut(table.join(wanted, "source", "left").withColumn("_want", F.coalesce("_want", F.lit(0.0))))
    f_lang, f_topic = np.ones(len(langs)), np.ones(len(topics))

    def weighted() -> DataFrame:
        """Cells with the source factor that fits the present language and topic factors."""
        of = lambda names, values: F.create_map(*[F.lit(x) for n, v in zip(names, values.tolist()) for x in (n, v)])
        inner = of(langs, f_lang)[F.col("lang")] * of(topics, f_topic)[F.col("topic")]
        made = table.withColumn("_inner", inner)
        fits = made.groupBy("source").agg(F.sum(F.col("tokens") * F.col("_inner")).alias("_have"), F.first("_want").alias("_target"))
        factor = F.when(F.col("_have") > 0, F.col("_target") / F.col("_have")).otherwise(0.0)
        return made.join(fits.select("source", factor.alias("_f")), "source").withColumn("factor", F.col("_f") * F.col("_inner"))

    off = 0.0
    for _ in range(rounds):
        grid = np.zeros((len(langs), len(topics)))
        for r in weighted().groupBy("lang", "topic").agg(F.sum(F.col("tokens") * F.col("factor")).alias("w")).collect():
            grid[langs.index(r["lang"]), topics.index(r["topic"])] = r["w"]
        off = max(np.abs(grid.sum(1) - want_lang).max(), np.abs(grid.sum(0) - want_topic).max()) / total
        if off < tolerance:
            break
        for _ in range(20):  # sums by language and topic are few: fit both to each other
            rows = grid.sum(1)
            step = np.divide(want_lang, rows, out=np.zeros_like(rows), where=rows > 0)
            f_lang, grid = f_lang * step, grid * step[:, None]
            columns = grid.sum(0)
            step = np.divide(want_topic, columns, out=np.zeros_like(columns), where=columns > 0)
            f_topic, grid = f_topic * step, grid * step
    else:
        told = f"the fit has not converged after {rounds} rounds: a language or topic is {off:.2%} of all tokens off its target"
        if strict:
            raise ValueError(told)
        warnings.warn(told, stacklevel=2)
    return weighted().select("source", "lang", "topic", "tokens", "factor")


def sampled(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", keep: str = "doc_id", topic: Column | None = None,
            share: float = SHARE, seed: int = 42, columns: Sequence[str] | None = None, **targets) -> DataFrame:
    """Documents drawn share * factor times, on average, for the factor of their cell.

    Returns `columns` (all that came, by default) plus `mix_topic`,
    `mix_tokens`, `mix_weight` (the cell's factor), `mix_probability` (the
    expected number of copies) and `mix_copies` (how many there are of this row);
    columns of these names are replaced.  The whole part of share * factor is
    the number of copies of every document of the cell and the rest is drawn for
    one more, so the sample has the target shares and `share` of all tokens, on
    average, for any share: 2 gives each token twice, on average.  No document
    has over share * factor + 1 copies, which is most for a small cell with a
    large target.  The draw
    depends on the id, the text and the seed only, so it is the same on every
    run and copies of a row are drawn together.  Documents without a word have
    no weight and are not drawn; null labels are a label of their own.  The
    labelled rows are written once and read for the sums and for the draw.
    """
    new = ("mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_copies")
    columns = [c for c in columns or docs.columns if c not in new]
    if topic is None:
        topic = topic_of(F.coalesce(docs[text], F.lit("")))
    packed = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(columns)], docs[keep].alias("_id"), docs[text].alias("_text"),
                         docs[source].alias("_source"), docs[lang].alias("_lang"), topic.alias("_topic"))
    draw = F.shiftrightunsigned(F.xxhash64("_id", "_text", F.lit(seed)), 11) / F.lit(float(1 << 53))
    rows = cut(labelled(packed, "_text", "_source", "_lang", F.col("_topic")).withColumn("_draw", draw).select(
        *[f"c{i}" for i in range(len(columns))], "_mix", "_draw"))
    fitted = cut(rake(cut(cells(rows)), **targets).select(F.struct("source", "lang", "topic").alias("_cell"), "factor"))
    copies = F.floor("_expected").cast("int") + (F.col("_draw") < F.col("_expected") - F.floor("_expected")).cast("int")
    placed = rows.filter("_mix.tokens > 0").withColumn("_cell", F.struct("_mix.source", "_mix.lang", "_mix.topic")).join(fitted, "_cell").withColumn("_expected", F.col("factor") * share)
    drawn = placed.withColumn("_copies", copies).filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return drawn.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.col("_mix.topic").alias("mix_topic"), F.col("_mix.tokens").alias("mix_tokens"),
        F.col("factor").alias("mix_weight"), F.col("_expected").alias("mix_probability"), F.col("_copies").alias("mix_copies"))

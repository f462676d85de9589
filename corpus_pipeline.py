"""A corpus pipeline: from raw documents to a mixed sample, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leasewise.llm import benchmark, mixing, quality, secrets, simhash
from leasewise.llm.common import table
from leasewise.session import cut


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; their limits come from all documents given.

    Null and empty texts have no words and go.  Repeated rows are judged alike;
    null languages and sources are groups of their own.  An empty table stays empty.
    """
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHashes (3-word shingles) link at 3 or fewer differing bits.

    The smallest id stays, null ids last; of rows with that id the one with the
    smallest text digest, so one of repeated rows.  Texts without a word (null,
    empty) are one group.  An empty table stays empty.
    """
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Each row is judged by itself, so repeated rows go or stay together; null
    and empty texts hold no passage and stay.  An empty table, or one of items
    without text, changes nothing.
    """
    return benchmark.without_matches(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew.

    Null texts stay null and get a null n_chars, empty ones stay empty.  Equal
    texts get equal marks.  An empty table stays empty; the model is then
    fitted on its made lines alone.
    """
    clean = secrets.redacted(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered shares of sources, languages and topics, with the weights used.

    Null languages and sources are values of their own; texts without a word
    (null, empty) weigh nothing and are not drawn.  Repeated rows have the same
    draw.  An empty table gives an empty sample.
    """
    return mixing.sampled(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", hide_secrets),
    ("source mixing", mix_sources),
]

# Fingerprints, fields and fitting have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

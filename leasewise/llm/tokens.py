"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import by_text

CACHE_PIECES = 400_000  # counts of short pieces that a worker keeps
CACHE_BYTES = 48  # longer pieces are counted anew in each batch

_loaded: dict[str, tuple[object, dict[bytes, int]]] = {}  # per Python worker


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = tokenizer, {}
    return _loaded[path]


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text, without begin, end or added special tokens.

    The vocabulary drops white space, so a cut at ASCII white space never
    parts a token and the count of a text is the sum over its pieces.  Equal
    pieces of a batch are encoded once.
    """
    tokenizer, cache = _tokenizer(path)
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    new = list({p for one in split for p in one if p not in cache})
    if len(cache) + len(new) > CACHE_PIECES:
        cache.clear()
        new = list({p for one in split for p in one})
    counts = dict(zip(new, map(len, tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in new], add_special_tokens=False))))
    if cache:
        found = {p: cache[p] for one in split for p in one if p in cache}
        found.update(counts)
    else:
        found = counts
    cache.update((p, n) for p, n in counts.items() if len(p) <= CACHE_BYTES)
    return [sum(map(found.__getitem__, one)) for one in split]


def token_counts(docs: DataFrame, path: str, keep: str = "doc_id", text: str = "text", limit: int = 2048,
                 batch_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: its id, UTF-8 bytes, tokens, and whether it is over `limit`.

    `path` names a vocabulary file that drops white space (word_bpe kind); it
    must be there on every executor.  Rows are encoded in batches of about
    `batch_bytes` of text, whatever their number.  A null or empty text has 0
    bytes and 0 tokens; a null id stays null; repeated rows are counted each.
    Columns other than the two named are not read.
    """
    counted = by_text(docs, [keep], text, "n_bytes long, n_tokens long", lambda texts: {
        "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64()),
        "n_tokens": pa.array(count_texts(texts, path), pa.int64())}, batch_bytes)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

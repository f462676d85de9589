"""Substring dedup: matching statistics against suffix automata of reference shards.

A passage that stands in two places has the same smallest word-gram in both,
its anchor, so only stretches of text with the same anchor can repeat each
other.  A stretch ends where its windows leave the place of their anchor, so
it has `window - gram + 1` windows at most, none of them twice, and a periodic
text is many stretches with few contents.  The stretches of an anchor are a
reference shard; each distinct one enters the shard's automaton once, with its
number of places, and is then streamed through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut, cut_bucketed
from .common import by_text, group_starts, pieces, whole_groups

WINDOW = 35  # words of the shortest passage that is removed
GRAM = 8  # words of an anchor
SHARD = 1024  # distinct stretches of one anchor that share an automaton: 63,488 words at most

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


# ---- suffix automaton

class Automaton:
    """Suffix automaton of several sequences, each with a weight; counts places of every substring."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]
        self.often: list[int] = []

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.places.append(0)
        return len(self.length) - 1

    def _clone(self, p: int, sign: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(sign) == q:
            self.next[p][sign] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, sign: int) -> int:
        follow, length = self.next, self.length
        q = follow[last].get(sign)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, sign, q)
        state, p = self._state(length[last] + 1, 0, {}), last
        while p >= 0 and sign not in follow[p]:
            follow[p][sign] = state
            p = self.link[p]
        if p >= 0:
            q = follow[p][sign]
            self.link[state] = q if length[q] == length[p] + 1 else self._clone(p, sign, q)
        return state

    def add(self, signs: list[int], weight: int = 1) -> None:
        last = 0
        for sign in signs:
            last = self._extend(last, sign)
            self.places[last] += weight

    def close(self, least: int = 2) -> None:
        """Count places, and find for each state its longest suffix with `least` places."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for v in reversed(order):
            self.places[self.link[v]] += self.places[v]
        self.often = [0] * len(self.length)
        for v in order:
            self.often[v] = v if self.places[v] >= least else self.often[self.link[v]]

    def statistics(self, signs: list[int]) -> list[int]:
        """For each position, the length of the longest match that ends there and has enough places."""
        out, state, held = [], 0, 0
        for sign in signs:
            while state and sign not in self.next[state]:
                state = self.link[state]
                held = self.length[state]
            if sign in self.next[state]:
                state, held = self.next[state][sign], held + 1
            best = self.often[state]
            out.append(held if best == state else self.length[best])
        return out


def spans(statistics: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal stretches covered by matches of `window` words or more."""
    out: list[list[int]] = []
    for end, length in enumerate(statistics, 1):
        if length >= window:
            if out and end - length <= out[-1][1]:
                out[-1] = [min(out[-1][0], end - length), end]
            else:
                out.append([end - length, end])
    return [(s, e) for s, e in out]


# ---- stretches

def _hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and where each text starts."""
    words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    starts = np.cumsum([0, *map(len, words)])
    return np.fromiter((xxhash.xxh64_intdigest(w) for one in words for w in one), np.uint64, starts[-1]), starts


def _minima(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(words: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows with the same place of their anchor: text number, first word, windows, anchor, content hash.

    The anchor of a window is its smallest gram, the first of equal ones.  A
    window gives the anchor's offset within it, so no window stands twice in a
    run.  Content hashes are of 64 bits.
    """
    names = ("text", "at", "n", "anchor", "content")
    if len(words) < window:
        return {n: np.zeros(0, np.int64) for n in names}
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    width = window - gram + 1  # grams of a window
    powers = np.multiply.accumulate(np.full(gram, _MULTIPLIER, np.uint64))
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for j in range(gram):
        grams += words[j:len(grams) + j] * powers[j]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    least = _minima(grams, width)
    n = len(least)
    whole = text[:n] == text[window - 1:]
    left = (least[1:] != least[:-1]) | (grams[:n - 1] == least[:-1])  # another anchor, or the anchor was the first gram
    first = np.flatnonzero(np.r_[True, left | (text[1:n] != text[:n - 1]) | (whole[1:] != whole[:-1])])
    last = np.r_[first[1:], n]
    first, last = first[whole[first]], last[whole[first]]
    anchor = least[first]
    up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(words), _MULTIPLIER, np.uint64)])
    down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(words), _INVERSE, np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum(words * up[:-1])]
    content = (total[last + window - 1] - total[first]) * down[first] * np.uint64(_MULTIPLIER) + (last - first).astype(np.uint64)
    values = (text[first], first - starts[text[first]], last - first, anchor.view(np.int64), content.view(np.int64))
    return dict(zip(names, values))


_RUN = "array<struct<at: int, n: int, anchor: bigint, content: bigint>>"


def _runs(texts: list[str | None], window: int, gram: int) -> dict[str, pa.Array]:
    words, starts = _hashes(texts)
    made = stretches(words, starts, window, gram)
    rows = pa.StructArray.from_arrays(
        [pa.array(made["at"].astype(np.int32)), pa.array(made["n"].astype(np.int32)), pa.array(made["anchor"]), pa.array(made["content"])],
        ["at", "n", "anchor", "content"])
    return {"runs": pa.ListArray.from_arrays(np.searchsorted(made["text"], np.arange(len(texts) + 1)).astype(np.int32), rows)}


def _content(texts: list[str | None], wanted: list[list[dict]], window: int) -> dict[str, pa.Array]:
    """Word hashes of the wanted stretches; for large shards the hash of each of their windows instead."""
    words, starts = _hashes(texts)
    out = []
    for k, items in enumerate(wanted):
        made = []
        for item in items:
            a = starts[k] + item["at"]
            part = words[a:a + item["n"] + window - 1]
            if item["large"]:
                powers = np.multiply.accumulate(np.full(window, _MULTIPLIER, np.uint64))
                part = (np.lib.stride_tricks.sliding_window_view(part, window) * powers).sum(axis=1, dtype=np.uint64)
            made.append({"anchor": item["anchor"], "content": item["content"], "large": item["large"], "places": item["places"], "words": part.view(np.int64)})
        out.append(made)
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("content", pa.int64()), ("large", pa.bool_()), ("places", pa.int64()), ("words", pa.list_(pa.int64()))]))
    return {"parts": pa.array(out, kind)}


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Spans of each stretch that have two places or more in its shard; rows come sorted by anchor."""
    for batch in whole_groups(batches, ["anchor"]):
        starts = group_starts(batch, ["anchor"])
        lists = batch.column("words")
        flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        places = batch.column("places").to_pylist()
        found: list[list[tuple[int, int]]] = []
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            automaton = Automaton()
            parts = [flat[offsets[i]:offsets[i + 1]].tolist() for i in range(a, b)]
            for part, weight in zip(parts, places[a:b]):
                automaton.add(part, weight)
            automaton.close()
            found += [spans(automaton.statistics(part), window) for part in parts]
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        yield pa.RecordBatch.from_pydict({
            "anchor": batch.column("anchor"), "content": batch.column("content"),
            "covered": pa.array([[{"low": s, "high": e} for s, e in f] for f in found], kind)})


# ---- the operator

def _texts(docs: DataFrame, text: str) -> DataFrame:
    """(key, text, copies): each distinct text once, in a table bucketed by key.

    Buckets let the two later joins on the key leave the texts where they are;
    `leasewise.session.release` drops the table with the other cuts.
    """
    distinct = docs.select(F.coalesce(docs[text], F.lit("")).alias("text")).groupBy(F.unhex(F.md5("text")).alias("key")).agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return cut_bucketed(distinct, "key", compression="zstd")


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(key, spans): for each text with a repeated window, the word spans to remove.

    `texts` has one row for each distinct text, with its number of copies.
    """
    runs = cut(by_text(texts, ["key", "copies"], "text", f"runs {_RUN}", lambda t: _runs(t, window, gram)).select("key", "copies", F.inline("runs")))
    # An anchor in one place only repeats nothing.  One distinct stretch in
    # several places is covered whole; several need the automaton.
    anchors = cut(runs.groupBy("anchor").agg(
        F.sum("copies").alias("_all"), F.min("content").alias("_low"), F.max("content").alias("_high"))
        .filter("_all > 1").select("anchor", F.expr("_low != _high").alias("mixed")))
    hits = cut(runs.join(anchors, "anchor"))
    whole = hits.filter("not mixed").select("key", F.col("at").alias("low"), (F.col("at") + F.col("n") + window - 1).alias("high"))
    mixed = hits.filter("mixed")
    distinct = cut(mixed.groupBy("anchor", "content").agg(
        F.sum("copies").alias("places"), F.min(F.struct("key", "at", "n")).alias("_one")))
    sizes = distinct.groupBy("anchor").agg((F.count(F.lit(1)) > shard).alias("large"))
    wanted = distinct.join(sizes, "anchor").select("_one.key", F.struct("anchor", "content", "places", "large", "_one.at", "_one.n").alias("item"))
    wanted = wanted.groupBy("key").agg(F.collect_list("item").alias("items"))  # a text's own stretches
    parts = _with_items(texts.join(wanted.hint("shuffle_hash"), "key"), window).select(F.inline("parts"))
    parts = cut(parts)
    small = parts.filter("not large").select("anchor", "content", "places", "words").repartition("anchor").sortWithinPartitions("anchor", "content")
    covered = small.mapInArrow(lambda b: _shards(b, window), "anchor long, content long, covered array<struct<low: int, high: int>>").filter(F.size("covered") > 0)
    # A shard over the limit is split by the content of its windows, which are counted.
    windows = parts.filter("large").select("anchor", "content", "places", F.posexplode("words").alias("low", "hash"))
    counted = windows.groupBy("anchor", "hash").agg(F.sum("places").alias("_n")).filter("_n > 1").drop("_n")
    large = windows.join(counted, ["anchor", "hash"]).select("anchor", "content", "low", (F.col("low") + window).alias("high"))
    ranges = covered.select("anchor", "content", F.inline("covered")).unionByName(large)
    partly = mixed.select("key", "anchor", "content", "at").join(ranges, ["anchor", "content"]).select(
        "key", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high"))
    return whole.unionByName(partly).groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # a text's own spans


def _with_items(joined: DataFrame, window: int) -> DataFrame:
    schema = "parts array<struct<anchor: bigint, content: bigint, large: boolean, places: bigint, words: array<bigint>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_pydict(_content(piece.column("text").to_pylist(), piece.column("items").to_pylist(), window))

    return joined.select("text", "items").mapInArrow(run, schema)


def kept_words(text: str | None, spans: list[dict] | None) -> tuple[list[str], int]:
    """The words of a text outside of the spans, and the number of all its words."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not spans:
        return words, len(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["low"] for s in spans], 1)
    np.add.at(edge, [s["high"] for s in spans], -1)
    return [w for w, n in zip(words, np.cumsum(edge).tolist()) if n == 0], len(words)


def _cleaned(joined: DataFrame, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digest, clean = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                kept, n = kept_words(text, found)
                body = b" ".join(kept)
                n_words.append(n)
                n_removed.append(n - len(kept))
                digest.append(hashlib.sha256(body).hexdigest())
                clean.append(body.decode("utf-8", "surrogatepass") if with_text else None)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()), "clean": pa.array(clean, pa.string())})

    return joined.select("key", "text", "spans").mapInArrow(run, "key binary, n_words long, n_removed long, kept_sha256 string, clean string")


def substring_dedup(docs: DataFrame, keep: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                    shard: int = SHARD, with_text: bool = False) -> DataFrame:
    """One row per document: id, words, removed words, SHA-256 of the kept words (`clean` too, if asked for).

    Every word of a window of `window` words that also starts anywhere else,
    in the same document or another, is removed; windows are judged on the
    input.  Null and empty texts have no words.  Repeated rows are copies of
    each other, so their windows all go.  Columns other than the two named
    are not read.
    """
    texts = _texts(docs, text)
    done = _cleaned(texts.select("key", "text").join(repeated_spans(texts, window, gram, shard).hint("shuffle_hash"), "key", "left"), with_text)
    ids = docs.select(docs[keep].alias("_keep"), F.unhex(F.md5(F.coalesce(docs[text], F.lit("")))).alias("key"))
    out = ids.join(cut(done), "key").drop("key").withColumnRenamed("_keep", keep)
    return out if with_text else out.drop("clean")


SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
windows AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split WHERE len(words) >= {WINDOW})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM again),
each AS (SELECT r, i, words[i] AS w FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM split)),
kept AS (SELECT e.r, count(*) AS n, string_agg(e.w, ' ' ORDER BY e.i) AS body FROM each e LEFT JOIN gone g ON g.r = e.r AND g.i = e.i WHERE g.i IS NULL GROUP BY e.r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM split LEFT JOIN kept k USING (r)
"""

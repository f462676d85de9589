"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup, exact check.

A window of a document is compared with the items of its own length.  Only
windows that hold a word shingle of such an item can be similar to it, so only
these get a fingerprint.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import by_text, named_back, numbered

SHINGLE = 5
SIMILAR = 0.8
BITS = 128
RADIUS = 40  # texts of similarity 0.8 differ in 19 bits on average, with a deviation of 4
BLOCKS = BITS // 8
NEAR = RADIUS // BLOCKS  # some block of two fingerprints within RADIUS differs in so many bits at most
ITEMS_AT_ONCE = 20_000  # items whose index is sent to the tasks together

_WORD = re.compile(r"\w+")


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: letters and digits in lower case, signs dropped."""
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code for each run of `width` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    codes = np.zeros(n, np.uint64)
    for j in range(width):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + words[j:n + j]
    return _mixed(codes)


def _bits(codes: np.ndarray) -> np.ndarray:
    """One row of BITS zeros and ones for each code."""
    halves = np.stack([_mixed(codes + np.uint64(1)), _mixed(codes + np.uint64(2))], axis=1)
    return np.unpackbits(halves.astype(">u8").view(np.uint8).reshape(len(codes), BLOCKS), axis=1)


def fingerprints(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Packed majority bits over `size` codes from each start."""
    sums = np.vstack([np.zeros((1, BITS), np.int32), np.cumsum(_bits(codes), axis=0, dtype=np.int32)])
    return np.packbits(2 * (sums[starts + size] - sums[starts]) > size, axis=1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: a shingle weighs as often as it occurs."""
    both = sum((a & b).values())
    return both / max(sum(a.values()) + sum(b.values()) - both, 1)


@dataclass
class Sized:
    """Items of one length: block tables over their fingerprints, and their shingles."""
    size: int
    ids: list[list[int]]  # ids of the rows with the item's words
    counts: list[Counter]
    prints: np.ndarray
    starts: np.ndarray  # block, value -> first place in `members`
    members: list[np.ndarray]  # for each block, items near each value

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS, by way of the block tables."""
        found = []
        for block in range(BLOCKS):
            low, high = self.starts[block][prints[:, block]], self.starts[block][prints[:, block].astype(np.int64) + 1]
            n = high - low
            window = np.repeat(np.arange(len(prints)), n)
            place = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append(window * len(self.ids) + self.members[block][place])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.ids), pairs % len(self.ids)
        close = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1) <= RADIUS
        return window[close], item[close]


class Index:
    """Items by length, and for each shingle the lengths of the items that hold it."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        by_words: dict[bytes, tuple[np.ndarray, list[int]]] = {}
        for item_id, text in items:
            words = word_hashes(text)
            if len(words):
                by_words.setdefault(words.tobytes(), (words, []))[1].append(item_id)
        self.sized: dict[int, Sized] = {}
        sizes: dict[int, dict[int, set[int]]] = {}  # shingle width -> code -> lengths
        for size in sorted({len(w) for w, _ in by_words.values()}):
            own = [(w, ids) for w, ids in by_words.values() if len(w) == size]
            width = min(SHINGLE, size)
            codes = [shingles(w, width) for w, _ in own]
            prints = np.vstack([fingerprints(c, np.zeros(1, np.int64), len(c)) for c in codes])
            starts, members = np.zeros((BLOCKS, 257), np.int64), []
            values = np.arange(256, dtype=np.uint8)
            for block in range(BLOCKS):
                near = np.bitwise_count(values[:, None] ^ prints[None, :, block]) <= NEAR
                starts[block, 1:] = np.cumsum(near.sum(axis=1))
                members.append(np.nonzero(near)[1])
            self.sized[size] = Sized(size, [ids for _, ids in own], [Counter(c.tolist()) for c in codes], prints, starts, members)
            for c in codes:
                for code in c.tolist():
                    sizes.setdefault(width, {}).setdefault(code, set()).add(size)
        self.widths = {w: (np.array(sorted(m), dtype=np.uint64), m) for w, m in sizes.items()}

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, float]]:
        """(item_id, first word, words, similarity) of the best window of each item found in a text."""
        words = word_hashes(text)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for width, (known, lengths) in self.widths.items():
            codes = shingles(words, width)
            if not len(codes):
                continue
            at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            hits = np.flatnonzero(known[at] == codes)
            by_size: dict[int, list[int]] = {}
            for place, code in zip(hits.tolist(), codes[hits].tolist()):
                for size in lengths[code]:
                    by_size.setdefault(size, []).append(place)
            for size, places in by_size.items():
                for start, similar, item in self._windows(codes, np.array(places), size, width):
                    old = best.get((size, item))
                    if old is None or (similar, -start) > (old[0], -old[1]):
                        best[size, item] = similar, start
        return [(i, start, min(size, len(words)), similar) for (size, item), (similar, start) in best.items() for i in self.sized[size].ids[item]]

    def _windows(self, codes: np.ndarray, places: np.ndarray, size: int, width: int) -> Iterator[tuple[int, float, int]]:
        n = size - width + 1  # shingles of a window
        last = len(codes) - n
        if last < 0:  # shorter than the items: the whole document is the window, where its length allows the similarity
            if len(codes) >= SIMILAR * n:
                own, whole = self.sized[size], Counter(codes.tolist())
                for _, item in zip(*own.near(fingerprints(codes, np.array([0]), len(codes)))):
                    similar = similarity(whole, own.counts[item])
                    if similar >= SIMILAR:
                        yield 0, similar, int(item)
            return
        edge = np.zeros(last + 2, np.int64)  # windows that hold a hit
        low, high = np.maximum(places - n + 1, 0), np.minimum(places, last)
        fits = low <= high
        np.add.at(edge, low[fits], 1)
        np.add.at(edge, high[fits] + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        own = self.sized[size]
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):  # stretches far apart, then bounded pieces
            for k in range(0, len(part), 8192):
                piece = part[k:k + 8192]
                if not len(piece):
                    continue
                prints = fingerprints(codes[piece[0]:piece[-1] + n], piece - piece[0], n)
                for window, item in zip(*own.near(prints)):
                    start = int(piece[window])
                    similar = similarity(Counter(codes[start:start + n].tolist()), own.counts[item])
                    if similar >= SIMILAR:
                        yield start, similar, int(item)


def indexes(items: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes over all items, ITEMS_AT_ONCE or so in each, so that what a task gets stays bounded."""
    parts = max(1, math.ceil(items.count() / ITEMS_AT_ONCE))
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64(items[item], items[text]), F.lit(parts)) == part) if parts > 1 else items
        yield Index([(r[0], r[1]) for r in block.select(item, text).collect()])


_MATCH = "array<struct<item_id: bigint, first_word: bigint, n_words: bigint, similarity: double>>"
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())]))


def benchmark_matches(docs: DataFrame, items: DataFrame, keep: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc, item_id, first_word, n_words, similarity): the best window of each item that a document holds.

    A window has as many words as the item, or all of a shorter document; similarity is weighted Jaccard
    over five-word shingles (all words where there are fewer), 0.8 or more.
    Null and empty texts and items match nothing; rows repeat as documents and
    items do; a null id stays null.  Large benchmarks go over the documents in
    blocks of items.  Columns other than those named are not read.
    """
    found = None
    for index in indexes(items, item, item_text):
        def run(texts: list[str | None], index: Index = index) -> dict[str, pa.Array]:
            names = ("item_id", "first_word", "n_words", "similarity")
            return {"_m": pa.array([[dict(zip(names, m)) for m in index.matches(t)] for t in texts], _MATCH_TYPE)}

        part = by_text(docs, [keep], text, f"_m {_MATCH}", run).select(F.col(keep), F.inline("_m"))
        found = part if found is None else found.unionByName(part)
    return found


def without_matches(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows that hold no item, with the columns they came with.

    Each row is judged by itself: repeated rows go or stay together.  Null and
    empty texts hold no item and stay; items without words match nothing.  An
    empty table stays empty, and without items all rows stay.
    """
    rows, (body,) = numbered(docs, text)
    rest = [c for c in rows.columns if c != body]
    for index in indexes(items, item, item_text):
        def run(texts: list[str | None], index: Index = index) -> dict[str, pa.Array]:
            return {"_clean": pa.array([not index.matches(t) for t in texts]), "_body": pa.array(texts, pa.string())}

        rows = by_text(rows, rest, body, "_clean boolean, _body string", run).filter("_clean").withColumnRenamed("_body", body)
    return named_back(rows, docs.columns)

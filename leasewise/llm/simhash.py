"""SimHash near-duplicates: block buckets, BK-trees in each, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .common import by_text, group_starts, named_back, numbered, whole_groups

RADIUS = 3
BLOCKS = (13, 13, 13, 13, 12)  # widths; RADIUS differing bits leave at least two of five whole
PART_BITS = 5  # a large bucket is cut by its free bits, in parts of this width at most
LARGE = 4096  # fingerprints in a bucket that are compared without a further cut
PAIRS_AT_ONCE = 4_000_000  # comparisons held in memory


# ---- fingerprints

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits over the XXH64 (seed 42) of the word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))]
    hashes = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):  # bounds the unpacked bits of a long text
        ones += np.unpackbits(hashes[start:start + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(keep, fp): the fingerprint as a signed long."""
    return by_text(docs, [keep], text, "fp long", lambda texts: {
        "fp": pa.array(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))})


# ---- BK-trees

def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree for each bucket, built and searched level by level.

    A node's children are keyed by their integer Hamming distance to it; all
    trees are held in one sorted array of (parent, distance) keys.
    """

    def __init__(self, fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.fp, self.root = fp, np.repeat(starts, sizes)
        edges, nodes = [], []
        active = np.flatnonzero(np.arange(len(fp)) != self.root)
        at = self.root[active]
        while len(active):
            key = at * 65 + _distance(fp[active], fp[at])
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            edges.append(key[first])
            nodes.append(active[first])
            rest = np.ones(len(active), dtype=bool)
            rest[first] = False
            at, active = active[first][group][rest], active[rest]
        keys = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.nodes = np.concatenate(nodes)[order] if nodes else np.zeros(0, np.int64)

    def search(self, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(item, node) pairs within the radius, following only edges that can hold one."""
        found, item, node = [], items, self.root[items]
        while len(item):
            d = _distance(self.fp[item], self.fp[node])
            near = (d <= radius) & (node < item)
            found.append((item[near], node[near]))
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            n = high - low
            begin = np.repeat(low - (np.cumsum(n) - n), n)
            item, node = np.repeat(item, n), self.nodes[begin + np.arange(n.sum())]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def links(fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links within each bucket, as (node, smaller representative)."""
    forest = Forest(fp, starts, sizes)
    label = np.arange(len(fp))
    work = np.cumsum(np.repeat(sizes, sizes))
    for chunk in np.split(np.arange(len(fp)), np.flatnonzero(np.diff(work // PAIRS_AT_ONCE)) + 1):
        a, b = forest.search(chunk, radius)
        while len(a):
            a, b = label[a], label[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low != high
            a, b = high[open_], low[open_]
            np.minimum.at(label, a, b)
            while (label != label[label]).any():
                label = label[label]
    node = np.flatnonzero(label != np.arange(len(fp)))
    return fp[node], fp[label[node]]


# ---- buckets

def _masks(widths: list[int], free: int, left: int = 64) -> list[int]:
    """Masks over the blocks that stay when any `free` of them are left out."""
    blocks, at = [], left
    for w in widths:
        at -= w
        blocks.append(((1 << w) - 1) << at)
    return [sum(blocks) - sum(c) for c in combinations(blocks, free)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m in masks])
    return fps.select("fp", F.inline(keys))


def _split_masks(mask: int, radius: int) -> list[int]:
    """Masks for a large bucket: the bits it shares plus most of its free bits.

    The free bits are cut into parts; `radius` differing bits leave all but
    `radius` parts whole.  So a bucket by such a mask holds fingerprints that
    differ in `radius * PART_BITS` bits only: 32,768 at most for radius 3.
    """
    free = [i for i in range(63, -1, -1) if not mask >> i & 1]
    parts = [sum(1 << i for i in free[k:k + PART_BITS]) for k in range(0, len(free), PART_BITS)]
    return [mask | (sum(parts) - sum(c)) for c in combinations(parts, radius)]


def _linked(buckets: DataFrame, radius: int) -> DataFrame:
    """Links of buckets of bounded size: (a, b) with a spanning set per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["mask", "bits"]):
            starts, fp = group_starts(batch, ["mask", "bits"]), batch.column("fp").to_numpy(zero_copy_only=False)
            a, b = links(fp.view(np.uint64), starts, np.diff(np.r_[starts, len(fp)]), radius)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return buckets.select("mask", "bits", "fp").mapInArrow(run, "a long, b long")


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that give the same components as all links.

    Two fingerprints within the radius agree in two whole blocks, so they meet
    in the bucket of those blocks.  A bucket over LARGE is cut again by its
    free bits, which bounds every bucket; nothing is left out.
    """
    masks = _masks(list(BLOCKS), len(BLOCKS) - 2)
    if radius > len(BLOCKS) - 2:
        raise ValueError(f"these blocks hold for a radius of {len(BLOCKS) - 2} at most")
    first = _buckets(fps, masks)
    sizes = first.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = cut(first.join(sizes, ["mask", "bits"]))
    split = F.lit(None)
    for m in masks:
        split = F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(x)) for x in _split_masks(m, radius)])).otherwise(split)
    large = shared.filter(F.col("_n") > LARGE).select("fp", F.explode(split).alias("mask"))
    large = large.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
    every = shared.filter(F.col("_n") <= LARGE).select("mask", "bits", "fp").unionByName(large)
    return _linked(every.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp"), radius).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is its smallest node.

    Each round ranks the nodes anew by a hash, moves every node to the one of
    lowest rank among itself and its neighbours, and draws the edges between
    these, until no edge is left.  As ranks do not follow the ids, a round leaves
    half of the nodes of a path, in whatever order its ids stand, and of a star
    one: rounds grow with the logarithm of the nodes.  Rounds are written to
    the shared folder, so the plan does not grow.
    """
    edges = cut(edges.select(F.col("a").alias("a"), F.col("b").alias("b")))
    found, turn = None, 0
    while not edges.isEmpty():
        rank = lambda end: F.struct(F.xxhash64(end, F.lit(turn)), F.col(end).alias("node"))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min(rank("b")).alias("low")).select(F.col("a").alias("node"), F.least(rank("a"), "low")["node"].alias("low")))
        if found is None:
            found = low.select("node", F.col("low").alias("root"))
        else:
            step = low.select(F.col("node").alias("root"), F.col("low").alias("_next"))
            found = found.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
        turn += 1
        if turn % 4 == 0:
            found = cut(found)
        for end in ("a", "b"):
            edges = edges.join(low.select(F.col("node").alias(end), F.col("low").alias(f"_{end}")), end)
        edges = cut(edges.select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a != b").distinct())
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = cut(found)
    least = found.groupBy("root").agg(F.min("node").alias("_least"))
    return found.join(least, "root").select("node", F.col("_least").alias("root"))


def near_duplicates(docs: DataFrame, keep: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Fingerprints link at `radius` or fewer differing bits; component_id is the
    smallest id reachable over links.  Texts without a word (null, empty) have
    fingerprint zero and link like any other.  Shingles have `shingle` words, a
    shorter text is one shingle.  Repeated rows stay; a null id is no
    candidate for component_id, which is null where no row reached has an id.
    """
    marked = cut(fingerprints(docs, keep, text, shingle))
    placed = _placed(marked.groupBy("fp").agg(F.min(keep).alias("_least")), radius)
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    by_fp = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _placed(distinct: DataFrame, radius: int) -> DataFrame:
    """The rows of distinct fingerprints (`fp`) with the root of their component."""
    distinct = cut(distinct)
    roots = components(near_links(distinct.select("fp"), radius))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def one_of_each(docs: DataFrame, keep: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the columns it came with.

    The row with the smallest id stays, null ids last; of rows with that id
    the one with the smallest digest of its text, and of equal ones any.
    """
    named = docs.select(F.struct(docs[keep].isNull(), docs[keep], F.md5(F.coalesce(docs[text], F.lit("")))).alias("row"), docs[text].alias("_text"))
    marked = by_text(named.select(F.col("row.*"), "_text").toDF("none", "id", "digest", "_text"), ["none", "id", "digest"], "_text", "fp long", lambda texts: {
        "fp": pa.array(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))})
    placed = _placed(marked.groupBy("fp").agg(F.min(F.struct("none", "id", "digest")).alias("_least")), radius)
    return rows_that_stay(docs, keep, text, placed.groupBy("root").agg(F.min("_least").alias("_stay")))


def rows_that_stay(docs: DataFrame, keep: str, text: str, stay: DataFrame) -> DataFrame:
    """One row of `docs` for each `_stay`: (none, id, digest of the text)."""
    stay = stay.select(
        F.coalesce(F.col("_stay.id").cast("string"), F.lit("")).alias("_id"), F.col("_stay.digest").alias("_digest"))
    rows, (keep, text) = numbered(docs, keep, text)
    keyed = rows.withColumns({"_id": F.coalesce(F.col(keep).cast("string"), F.lit("")), "_digest": F.md5(F.coalesce(F.col(text), F.lit("")))})
    return named_back(keyed.join(stay, ["_id", "_digest"], "left_semi").dropDuplicates(["_id", "_digest"]), docs.columns)

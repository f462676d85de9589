import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import awkward
from conftest import rows
from leasewise.llm import simhash
from leasewise.session import cut


def plain_fingerprint(text, shingle=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, radius):
    """id -> smallest id reachable, from (id, fingerprint), comparing all pairs."""
    up = {i: i for i, _ in pairs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in pairs:
        for j, b in pairs:
            if i < j and (a ^ b).bit_count() <= radius:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in pairs}


def near(draw, center, bits):
    for b in draw.sample(range(64), bits):
        center ^= 1 << b
    return center


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("large", [4, simhash.LARGE])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)  # at 4 nearly every bucket is cut again
    draw = random.Random(3)
    fps = {draw.getrandbits(64) for _ in range(60)} | {0}
    for center in list(fps)[:25]:
        for _ in range(6):
            center = near(draw, center, draw.randint(1, 5))
            fps.add(center)
    fps = sorted(fps)
    found = simhash.components(simhash.near_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")))
    root = dict(rows(found))
    want = plain_components([(signed(f), f) for f in fps], 3)
    assert {f: root.get(f, f) for f in want} == want
    assert len(set(want.values())) < len(fps) - 50


def test_rounds_of_a_path_and_a_star(spark, monkeypatch):
    """A path of 10,000 nodes in ascending order and a star, in 20 rounds or fewer: three written tables a round at most."""
    path = spark.range(9_999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(20_001, 25_000).select(F.lit(20_000).cast("long").alias("a"), F.col("id").alias("b"))
    written = []
    monkeypatch.setattr(simhash, "cut", lambda df: written.append(1) or cut(df))
    found = simhash.components(path.unionByName(star)).groupBy("root").count()
    assert rows(found) == [(0, 10_000), (20_000, 5_000)]
    assert len(written) <= 2 + 2 * 20 + 20 // 4
    assert rows(simhash.components(path.limit(0))) == []


def test_forest_finds_all_within_radius():
    draw = np.random.default_rng(1)
    fp = np.unique(draw.integers(0, 2**12, 400, dtype=np.uint64))
    forest = simhash.Forest(fp, np.array([0, 150]), np.array([150, len(fp) - 150]))
    a, b = forest.search(np.arange(len(fp)), 3)
    got = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    want = {frozenset((i, j)) for s, e in ((0, 150), (150, len(fp))) for i in range(s, e) for j in range(s, i) if int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert got == want


def test_split_masks_meet_within_radius():
    draw = random.Random(5)
    for mask in simhash._masks(list(simhash.BLOCKS), 3)[:3]:
        cuts = simhash._split_masks(mask, 3)
        assert max(64 - m.bit_count() for m in cuts) <= 15
        for _ in range(50):
            a = draw.getrandbits(64)
            b = near(draw, a, 3)
            if a & mask == b & mask:
                assert any(a & m == b & m for m in cuts)


def test_rows_of_any_kind(spark):
    got = rows(simhash.near_duplicates(awkward.docs(spark)), "doc_id", "fingerprint")
    assert got == sorted([(r[0], f"{plain_fingerprint(r[1]):016x}") for r in awkward.DOCS], key=str)
    by_id = defaultdict(set)
    for i, _, c in rows(simhash.near_duplicates(awkward.docs(spark))):
        by_id[i].add(c)
    assert by_id[None] == {1} and by_id[1] == {1} and by_id[2] == {1} and by_id[7] == {7}  # no words: one group
    assert simhash.near_duplicates(awkward.empty(spark)).count() == 0
    kept = simhash.one_of_each(awkward.docs(spark))
    assert kept.columns == awkward.docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7, 7, 8, 9]  # two texts share id 7
    assert simhash.one_of_each(awkward.empty(spark)).count() == 0

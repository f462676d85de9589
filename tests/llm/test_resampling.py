import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import awkward
from conftest import rows
from leasewise.llm import resampling


def plain(docs, items):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    found = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for i in items for b in features(i)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for (i, _), (words, f) in zip(docs, found):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[:len(able) * 25 // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:5]) for r in out], key=str)


@pytest.mark.parametrize("ways", [2, 16])
def test_against_plain_loops(spark, ways):
    draw = random.Random(6)
    words = ["".join(draw.choice("abcXY9é漢") for _ in range(draw.randint(1, 4))) for _ in range(400)]
    docs = [(i, " ".join(draw.choice(words[i % 3 * 50:]) for _ in range(draw.choice([0, 5, 19, 20, 21, 90])))) for i in draw.sample(range(10**6), 300)]
    items = [" ".join(draw.choice(words[:200]) for _ in range(50)) for _ in range(20)] + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = rows(resampling.resampled(frame, spark.createDataFrame([(t,) for t in items], "text string"), ways=ways))
    assert got == plain(docs, items) and sum(r[4] is not None for r in got) > 30


@pytest.mark.parametrize("ways", [2, 5, 16])
def test_bisection_against_sorting(spark, ways):
    draw = random.Random(7)
    for values in ([-2**63, 2**63 - 1, 0, 0, -1], [3] * 9, [draw.randint(-50, 50) for _ in range(60)]):
        frame = spark.createDataFrame([(v,) for v in values], "v long")
        for n in {1, 2, len(values) // 2, len(values)}:
            assert resampling.nth_largest(frame, "v", n, ways) == sorted(values, reverse=True)[n - 1]


def test_ties_go_to_the_smaller_key(spark):
    scored = spark.createDataFrame([(k, s) for s in (5, 7) for k in range(-20, 20)] + [(None, 5), (None, 7), (3, 5)], "id long, score long")
    for n in (1, 30, 41, 45, 70, 82):
        chosen = rows(scored.filter(resampling.drawn(scored, "score", "id", F.lit(True), n)))
        order = sorted([tuple(r) for r in scored.collect()], key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        assert set(chosen) == set(order[:n]) and len(chosen) - n <= 1  # a repeated row may come along


def test_rows_of_any_kind(spark):
    docs = [(r[0], r[1]) for r in awkward.DOCS]
    target = spark.createDataFrame([("same text in two rows",), (None,), ("",)], "text string")
    assert rows(resampling.resampled(awkward.docs(spark), target)) == plain(docs, ["same text in two rows"])
    repeated = awkward.DOCS * 8  # equal rows get successive ranks, whichever of them
    got, want = rows(resampling.resampled(awkward.docs(spark, repeated), target)), plain([(r[0], r[1]) for r in repeated], ["same text in two rows"])
    assert got == want and sorted(r[4] for r in got if r[4]) == list(range(1, max(r[4] or 0 for r in want) + 1))
    none = spark.createDataFrame([], "text string")
    assert rows(resampling.resampled(awkward.docs(spark), none)) == plain(docs, [])
    assert resampling.resampled(awkward.empty(spark), target).count() == 0

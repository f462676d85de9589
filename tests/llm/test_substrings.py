import hashlib
import random
import re
from collections import Counter

import numpy as np

import awkward
from conftest import rows
from leasewise.llm import substrings


def plain(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    often = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if often[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def made(seed, count=120, vocabulary=400):
    """Texts with shared passages, near copies, exact copies and periodic stretches."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(vocabulary)}"
    shared = [[word() for _ in range(draw.randint(30, 90))] for _ in range(6)]
    texts = []
    for k in range(count):
        words = [word() for _ in range(draw.randint(0, 160))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(words))
            part = draw.choice(shared)
            a, b = sorted(draw.sample(range(len(part) + 1), 2))
            words[at:at] = draw.choice((part, part[a:b], [word()] * draw.randint(1, 60), (part[:draw.randint(2, 9)]) * 8))
        texts.append(" ".join(words))
        if texts and draw.random() < 0.3:
            copy = draw.choice(texts).split()
            for _ in range(draw.randint(0, 3)):
                if copy:
                    copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts


def result(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r[1:] for r in sorted(tuple(r) for r in substrings.substring_dedup(docs, **how).collect())]


def test_same_as_brute_force(spark):
    texts = made(1)
    want = plain(texts, 35)
    assert sum(w[1] for w in want) > 1000
    assert result(spark, texts) == want


def test_large_shards_are_split(spark):
    texts = made(2)
    assert result(spark, texts, shard=1) == plain(texts, 35)


def test_other_windows(spark):
    texts = made(3, vocabulary=12)
    assert result(spark, texts, window=12, gram=4, shard=5) == plain(texts, 12)


def test_rows_of_any_kind(spark):
    got = rows(substrings.substring_dedup(awkward.docs(spark)))
    want = [(r[0], *p) for r, p in zip(awkward.DOCS, plain([r[1] for r in awkward.DOCS], 35))]
    assert got == sorted(want, key=str)
    assert substrings.substring_dedup(awkward.empty(spark)).count() == 0


def test_automaton_statistics():
    draw = random.Random(4)
    parts = [[draw.randrange(3) for _ in range(draw.randint(1, 25))] for _ in range(12)]
    automaton = substrings.Automaton()
    for p in parts:
        automaton.add(p)
    automaton.close()
    count = lambda s: sum(p[i:i + len(s)] == s for p in parts for i in range(len(p) - len(s) + 1))
    for query in [*parts, [0, 9, 1, 2, 2, 0], [draw.randrange(4) for _ in range(30)]]:
        want = [max([n for n in range(1, i + 2) if count(query[i + 1 - n:i + 1]) >= 2], default=0) for i in range(len(query))]
        assert automaton.statistics(query) == want


def test_equal_windows_have_equal_anchors():
    texts = made(5)
    words, starts = substrings._hashes(texts)
    runs = substrings.stretches(words, starts)
    anchor_of = {}
    for t, at, n, anchor in zip(*(runs[k].tolist() for k in ("text", "at", "n", "anchor"))):
        for i in range(at, at + n):
            key = tuple(words[starts[t] + i:starts[t] + i + 35].tolist())
            assert anchor_of.setdefault(key, anchor) == anchor
    assert len(anchor_of) == len({tuple(words[a + i:a + i + 35].tolist()) for a, b in zip(starts, starts[1:]) for i in range(max(0, b - a - 34))})
    assert np.all(runs["n"] > 0) and np.all(runs["n"] <= 35 - 8 + 1)


def test_no_window_twice_in_a_stretch():
    texts = [*made(6, vocabulary=5), *(" ".join((f"p{k}" for k in range(period))) + (" " + " ".join(f"p{k}" for k in range(period))) * 90 for period in (1, 2, 7, 30))]
    words, starts = substrings._hashes(texts)
    runs = substrings.stretches(words, starts)
    for t, at, n in zip(*(runs[k].tolist() for k in ("text", "at", "n"))):
        inside = [tuple(words[starts[t] + i:starts[t] + i + 35].tolist()) for i in range(at, at + n)]
        assert len(set(inside)) == n


def test_long_periodic_texts(spark):
    """Texts of one repeated line, all of other lengths: few contents, each bounded, so the shard stays small."""
    line = [f"l{k}" for k in range(10)]
    texts = [" ".join((line * 200)[:1500 + 7 * k]) for k in range(60)] + ["a " * 900, "b " * 36, "c " * 35]
    assert result(spark, texts) == plain(texts, 35)
    words, starts = substrings._hashes(texts[:60])
    runs = substrings.stretches(words, starts)
    assert len(runs["n"]) > 5000 and len(set(zip(runs["anchor"].tolist(), runs["content"].tolist()))) < 30

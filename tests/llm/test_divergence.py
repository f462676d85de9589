import random
import re
from collections import Counter, defaultdict

import pytest

import awkward
from conftest import rows
from leasewise.llm import divergence


def plain(docs, least=10, top=10):
    """(lang, source, part, item, value, rank) with plain loops over whole texts."""
    found = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
             for text, lang, source in docs]
    out = []
    for lang in {l for l, _, _ in found}:
        own = [(s, words) for l, s, words in found if l == lang]
        holds = Counter(w for _, words in own for w in set(words))
        kept = sorted(w for w, n in holds.items() if n >= least)
        counts = defaultdict(Counter)
        for s, words in own:
            counts[s].update(w for w in words if holds[w] >= least)
        whole = sum(counts.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept}
        far = lambda a, b: (a - b) * (a - b) // (a + b)
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = [(sum(far(p[s][w], p[o][w]) for w in kept), o) for o in p if o != s]
            terms = [(far(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, listed in (("pair", pairs), ("term", terms)):
                listed.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(listed, 1) if part == "pair" or i <= top]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdé漢Zß") for _ in range(draw.choice([1, 2, 3, 4, 5, 8, 9, 17, 40, 70]))) for _ in range(300)]
    docs = []
    for i in range(240):
        own = words[:150] if i % 3 else words[60:]  # prefixes that many documents share, terms that few do
        text = " ".join(draw.choice(own) + draw.choice(["", "", "xyz", "1"]) for _ in range(draw.randint(0, 60)))
        docs.append((text, draw.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{draw.randint(0, 6)}"))
    return docs + [("one text", "xx", "alone"), (None, "en", "silent"), ("", "de", None), ("", "yy", "a"), (None, "yy", "b")]


@pytest.mark.parametrize("bounds", [{}, {"HELD": 50, "CHUNK": 7, "BLOCK": 3, "CELLS": 20, "BITS_AT_MOST": 15}])
@pytest.mark.parametrize("first_level", [1, 4])
def test_against_plain_loops(spark, monkeypatch, corpus, bounds, first_level):
    """Also with small limits everywhere: counts handed on early, many chunks and blocks, a full bit table."""
    for name, value in bounds.items():
        monkeypatch.setattr(divergence, name, value)
    frame = spark.createDataFrame(corpus, "text string, lang string, source string")
    want = plain(corpus)
    assert rows(divergence.source_divergence(frame, first_level=first_level)) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[:3] == ("yy", "a", "pair") and r[4] == 0 for r in want)


def test_levels_prune_and_end(spark, corpus):
    """The longest kept term ends the levels; what no level counts whole begins with a discarded prefix."""
    frame = spark.createDataFrame([((t or ""), l or "", s or "") for t, l, s in corpus], "text string, lang string, source string")
    kept = divergence.kept_terms(frame)
    holds = Counter((l or "", w) for t, l, _ in corpus for w in set(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))))
    assert {(r.lang, r.term) for r in kept.collect()} == {k for k, n in holds.items() if n >= 10}
    assert max(len(r.term.encode()) for r in kept.collect()) > 64


def test_bits_agree_with_python(spark):
    keys = [("en", "abcd".encode()), ("", b""), ("dé", "漢".encode()[:2]), ("x", b"a" * 100)]
    table, width = divergence._bits(spark.createDataFrame(keys, "lang string, key binary"))
    places = [divergence._hash(lang, key) >> (64 - width) for lang, key in keys]
    assert all(table[p >> 3] >> (p & 7) & 1 for p in places) and sum(int(b).bit_count() for b in table) == len(set(places))


def test_rows_of_any_kind(spark):
    want = plain([(r[1], r[2], r[3]) for r in awkward.DOCS * 6])
    assert rows(divergence.source_divergence(awkward.docs(spark, awkward.DOCS * 6))) == want and want
    assert divergence.source_divergence(awkward.empty(spark)).count() == 0

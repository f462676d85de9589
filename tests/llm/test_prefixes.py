import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import awkward
from conftest import rows
from leasewise.llm import prefixes
from leasewise.llm.prefixes import Fingerprint, Prefixes, code_points, likeness

TEXT = st.text(alphabet="ab漢\U0001f642", max_size=40)


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def made(text):
    return Prefixes(code_points(text))


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_extensions_against_comparing_characters(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    assert made(a).extension(i, made(b), j) == common(a[i:], b[j:])
    assert made(a).extension_back(i, made(b), j) == common(a[:i][::-1], b[:j][::-1])
    n = min(len(a) - i, len(b) - j)
    assert made(a).same(i, made(b), j, n) == (a[i:i + n] == b[j:j + n])
    spliced, whole = made(a).spliced(i, code_points(b)), made(a[:i] + b)
    assert all((x == y).all() for x, y in zip(spliced.sums, whole.sums))


def plain_likeness(a, b):
    """By comparing characters: what both begin and end with, in steps of the longer text's ladder."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    step = max(max(1, (1 << len(t).bit_length() - 1) // prefixes.RUNGS) for t in (a, b))
    agreed = (common(a, b) // step + common(a[::-1], b[::-1]) // step) * step
    longer = max(len(a), len(b))
    return min(agreed, len(a), len(b), longer - 1) / longer


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT, TEXT, st.sampled_from([1, 9]))
def test_likeness_against_comparing_characters(a, middle, b, times):
    one, other = (a * times + b), (a * times + middle + b)
    marks = [Fingerprint.of(made(t)) for t in (one, other)]
    assert likeness(*marks) == plain_likeness(one, other)
    assert (str(marks[0]) == str(marks[1])) == (one == other)
    back = Fingerprint.read(str(marks[0]))
    assert str(back) == str(marks[0]) and likeness(back, marks[1]) == likeness(*marks)


def plain(docs):
    """Rows of the query for (id, text) in order of their ids."""
    out = []
    for k, (i, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(Fingerprint.of(made(text))), str(Fingerprint.of(made(edited))),
                    plain_likeness(text, edited), plain_likeness(text, following)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7, 400])
def test_next_documents_over_any_ranges(spark, parts):
    draw = random.Random(2)
    docs = [(i, "".join(draw.choice("abcdefgh é漢") for _ in range(draw.choice([0, 1, 3, 4, 50, 700])))) for i in sorted(draw.sample(range(-10**12, 10**12), 150))]
    docs[20:24] = [(i, docs[20][1]) for i, _ in docs[20:24]]  # equal neighbours
    shuffled = draw.sample(docs, len(docs))
    frame = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    got = rows(prefixes.edit_fingerprints(frame, parts=parts))
    assert got == plain(docs)
    same = [r for r in got if r[0] in {i for i, _ in docs[20:23]}]
    assert all(r[6] == 1.0 for r in same) and len({r[3] for r in same}) == 1


def test_rows_of_any_kind(spark):
    solid = [(r[0], r[1]) for r in awkward.DOCS if r[0] is not None]
    want = plain(solid + [(None, None)])  # a null id comes last
    assert rows(prefixes.edit_fingerprints(awkward.docs(spark), parts=3)) == want
    assert prefixes.edit_fingerprints(awkward.empty(spark)).count() == 0
    for only in ([(5, "abcdefgh")], [(None, "abcdefgh")]):
        assert rows(prefixes.edit_fingerprints(spark.createDataFrame(only, "doc_id long, text string"))) == plain(only)


def test_long_text():
    codes = np.random.default_rng(1).integers(0, 1 << 20, 3_000_000)
    text = Prefixes(codes)
    assert text.extension(0, Prefixes(codes[1_000_000:]), 1_000_000) == 0
    assert text.extension(1_000_000, Prefixes(codes[1_000_000:]), 0) == 2_000_000

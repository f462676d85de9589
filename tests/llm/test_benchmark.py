import random
from collections import Counter

import awkward
from conftest import rows
from leasewise.llm import benchmark


def plain(docs, items):
    out = set()
    for d, text in docs:
        words = benchmark.word_hashes(text)
        for i, item in items:
            want = benchmark.word_hashes(item)
            n = len(want)
            if not n or n > len(words):
                continue
            width = min(5, n)
            count = Counter(benchmark.shingles(want, width).tolist())
            codes = benchmark.shingles(words, width).tolist()
            best = max((benchmark.similarity(Counter(codes[s:s + n - width + 1]), count), -s) for s in range(len(words) - n + 1))
            if best[0] >= 0.8:
                out.add((d, i, -best[1], n, round(best[0], 9)))
    return out


def made(seed):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(draw.choice((1, 3, 5, 8, 20, 40, 60))))) for i in range(60)]
    items += [(100, items[0][1]), (101, None), (102, ""), (None, " ".join(word() for _ in range(20)))]
    docs = []
    for d in range(150):
        words = [word() for _ in range(draw.randint(0, 150))]
        for _ in range(draw.randint(0, 2)):
            part = (draw.choice(items)[1] or "").split()
            for _ in range(draw.choice((0, 0, 1, 1, 2))):  # changed words, near and beyond the threshold
                if part:
                    part[draw.randrange(len(part))] = word()
            at = draw.randint(0, len(words))
            words[at:at] = part
        docs.append((d, " ".join(words)))
    return docs, items


def test_same_as_brute_force(spark):
    docs, items = made(1)
    found = benchmark.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(*r[:4], round(r[4], 9)) for r in map(tuple, found.collect())}
    want = plain(docs, items)
    assert len(want) > 100 and any(w[4] < 1 for w in want)
    assert got == want


def test_blocks_of_items(spark, monkeypatch):
    docs, items = made(2)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, clean = rows(benchmark.benchmark_matches(d, i)), rows(benchmark.without_matches(d, i))
    monkeypatch.setattr(benchmark, "ITEMS_AT_ONCE", 10)
    assert rows(benchmark.benchmark_matches(d, i)) == whole
    assert rows(benchmark.without_matches(d, i)) == clean
    assert {r[0] for r in clean} == {r[0] for r in docs} - {r[0] for r in whole}


def test_signs_and_case_do_not_hide_an_item(spark):
    items = spark.createDataFrame([(1, "Alpha beta, gamma: delta epsilon zeta.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so (ALPHA) beta gamma; Delta epsilon — zeta!"), (2, "alpha beta gamma delta and so on")], "doc_id long, text string")
    assert [r.doc_id for r in benchmark.benchmark_matches(docs, items).collect()] == [1]


def test_rows_of_any_kind(spark):
    items = spark.createDataFrame([(1, "same text in two rows"), (2, None), (3, "")], "item_id long, text string")
    got = rows(benchmark.benchmark_matches(awkward.docs(spark), items), "doc_id", "item_id", "first_word")
    assert got == [(7, 1, 0), (7, 1, 0)]
    clean = benchmark.without_matches(awkward.docs(spark), items)
    assert clean.columns == awkward.docs(spark).columns and clean.count() == len(awkward.DOCS) - 2
    none = items.filter("false")
    assert benchmark.benchmark_matches(awkward.docs(spark), none).count() == 0 and benchmark.without_matches(awkward.docs(spark), none).count() == len(awkward.DOCS)
    assert benchmark.benchmark_matches(awkward.empty(spark), items).count() == 0


def test_document_shorter_than_the_item():
    words = [f"w{i}" for i in range(50)]
    index = benchmark.Index([(1, " ".join(words))])
    assert index.matches(" ".join(words[:45])) == [(1, 0, 45, 41 / 46)]
    assert index.matches(" ".join(words[:40])) == []  # 36 of 46 shingles

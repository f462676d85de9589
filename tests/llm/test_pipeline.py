import random

import pytest

import awkward
import corpus_pipeline
from conftest import rows
from leasewise.llm import benchmark, quality, secrets, simhash
from test_simhash import plain_components, plain_fingerprint

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, copies, near copies, junk, benchmark passages and secrets."""
    draw = random.Random(1)
    sentence = lambda n: " ".join("".join(draw.choice("abcdefghiklmnop") for _ in range(draw.randint(2, 9))) for _ in range(n))
    items = [(i, sentence(30)) for i in range(5)]
    docs = [(i, sentence(draw.randint(60, 200))) for i in range(80)]
    docs += [(100 + i, docs[i][1]) for i in range(10)]
    docs += [(200 + i, docs[20 + i][1] + " end") for i in range(5)]
    docs += [(300 + i, f"{sentence(40)} {items[i][1]} {sentence(40)}") for i in range(5)]
    docs += [(400 + i, ("again and again " * 40)) for i in range(3)] + [(410, "too short"), (411, None), (412, "")]
    docs += [(500 + i, f"{sentence(50)} token = {'0123456789abcdef' * 2} {sentence(20)}") for i in range(4)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in docs], DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items


def test_stages_against_brute_force(spark, corpus):
    sf_dir, docs, items = corpus
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = dict(docs)
    # 1: what the verdicts keep
    done = [frame]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, done[-1], sf_dir)
        path = f"{sf_dir}/stage{len(done)}"
        out.write.parquet(path)
        done.append(spark.read.parquet(path))
    kept = [[r.doc_id for r in d.select("doc_id").orderBy("doc_id").collect()] for d in done]
    assert kept[1] == [r[0] for r in rows(quality.quality_verdicts(frame).filter("kept"), "doc_id")] or set(kept[1]) == {r[0] for r in rows(quality.quality_verdicts(frame).filter("kept"), "doc_id")}
    assert not set(kept[1]) & {400, 401, 402, 410, 411, 412} and set(range(80)) <= set(kept[1])
    # 2: the smallest id of each component
    roots = plain_components([(i, plain_fingerprint(text[i])) for i in kept[1]], 3)
    assert kept[2] == sorted(set(roots.values())) and not set(kept[2]) & set(range(100, 110))
    # 3: no document that holds an item
    index = benchmark.Index(items)
    assert kept[3] == [i for i in kept[2] if not index.matches(text[i])] and not set(kept[3]) & set(range(300, 305))
    # 4: all stay, without secrets; clean texts are as they were
    assert kept[4] == kept[3]
    after = {r.doc_id: r for r in done[4].collect()}
    assert all(not secrets.base_spans(r.text) and r.n_chars == len(r.text) for r in after.values())
    assert all(after[i].text == text[i] for i in kept[4] if i < 500) and all("[SECRET]" in after[i].text for i in range(500, 504))
    # 5: a sample with weights
    assert set(kept[5]) < set(kept[4]) and kept[5]
    assert all(d.columns == frame.columns for d in done[:-1]) and done[-1].columns[:5] == frame.columns
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(done[-1])


def test_stages_on_rows_of_any_kind(spark, corpus):
    sf_dir = corpus[0]
    for docs in (awkward.docs(spark), awkward.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.columns[:len(docs.columns)] == docs.columns
            out.write.format("noop").mode("overwrite").save()

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

import awkward
from conftest import rows
from leasewise.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Z", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", "　", "é", "e", "́", "̈", "Σ", "İ", "ß", "'s", "'", "1", "٣", "漢",
                                 "<|endoftext|>", "<|startoftext|>", "<|", "|>", "🙂", "-", "‍"]), max_size=30).map("".join))
def test_pieces_count_like_whole_texts(text):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(PATH) if not hasattr(test_pieces_count_like_whole_texts, "t") else test_pieces_count_like_whole_texts.t
    test_pieces_count_like_whole_texts.t = whole
    assert tokens.count_texts([text, None, ""], PATH) == [len(whole.encode(text, add_special_tokens=False).ids), 0, 0]


def test_rows_of_any_kind(spark, plain):
    got = rows(tokens.token_counts(awkward.docs(spark), PATH, limit=10, batch_bytes=100))
    want = [(r[0], len((r[1] or "").encode()), plain(r[1]), plain(r[1]) > 10) for r in awkward.DOCS]
    assert got == sorted(want, key=str)
    assert tokens.token_counts(awkward.empty(spark), PATH).count() == 0

"""Token counts against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinderlake.llm.tokens import TokenCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_in_context(library, counter):
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)} {chr(c)}{chr(c)}b {chr(c)}1" for c in points]
    got, want = counter.count(texts), expected(library, texts)
    wrong = [hex(c) for c, g, w in zip(points, got, want, strict=True) if g != w]
    assert wrong == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aab <|>endoftx\n'sé1. 　"), max_size=5))
def test_property(texts):
    assert TokenCounter_shared().count(texts) == expected(LIBRARY, texts)


LIBRARY = Tokenizer.from_file(PATH)
_shared = []


def TokenCounter_shared():
    if not _shared:
        _shared.append(TokenCounter(PATH))
    return _shared[0]


def test_long_sequences(library, counter):
    texts = ["a" * 5001, "ab" * 4000, "the" * 3000, " " * 999, "<|endoftext|>" * 7, ""]
    assert counter.count(texts) == expected(library, texts)


def test_rows(spark):
    rows = [(1, "hello world", 7), (None, None, 7), (2, "", 7), (1, "hello world", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=str)
    assert got == sorted([(1, 11, 2), (1, 11, 2), (None, 0, 0), (2, 0, 0)], key=str)
    assert count_tokens(docs.limit(0), PATH).count() == 0

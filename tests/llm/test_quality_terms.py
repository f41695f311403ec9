"""Terms of whole blocks of texts and packed context sums against plain loops."""

import random

import numpy as np
import pytest

from cinderlake.llm import quality
from cinderlake.llm.common import Interner

LETTERS = "aAbZß ÉéŒ9 ,.!\t\x0b\x1c\x00\x85 ΣςǅÀ漢 '_-"


def _odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices(LETTERS, k=rng.randrange(90))).encode() for _ in range(400)]
    return [*texts, b"", b" ", b"a", b"the a " * 25_000, b". " * 21_000, b""]


def _plain_codes(text):
    return [quality._word_and_shape(t) for t in quality._TERM.findall(text)]


@pytest.mark.parametrize("texts", [_odd_texts(), [], [b""], [b"\n", b""]])
def test_terms_and_sums_of_blocks(texts):
    index = quality.index_vectors()
    ids, firsts, own, at = quality._found(texts)
    codes = quality._codes(own, at, Interner(quality._word_and_shape))
    expected = np.zeros((quality.BUCKETS, quality.DIM))
    for text, a, b in zip(texts, firsts[:-1], firsts[1:], strict=True):
        plain = _plain_codes(text)
        assert codes[ids[a:b]].tolist() == plain
        for start in range(0, len(plain), quality._TERMS_AT_ONCE):
            w, s = np.divmod(plain[start : start + quality._TERMS_AT_ONCE], quality.BUCKETS)
            vectors = index[w] + index[s]
            around = np.zeros_like(vectors)
            for d in range(1, quality.REACH + 1):
                around[d:] += vectors[:-d]
                around[:-d] += vectors[d:]
            np.add.at(expected, w, around)
            np.add.at(expected, s, around)
    found = quality._ContextSums(index.astype(np.int8))
    found.add(ids, firsts, codes)
    found.flush()
    assert np.array_equal(found.sums, expected)


def test_sums_are_taken_apart_before_they_run_over(monkeypatch):
    index = np.zeros((quality.BUCKETS, quality.DIM), np.int8)
    index[:, 0], index[:, 1], index[:, 63] = -1, 1, -1
    ids, firsts, own, at = quality._found([b"a b " * 150_000])
    codes = quality._codes(own, at, Interner(quality._word_and_shape))
    found = quality._ContextSums(index)
    found.add(ids, firsts, codes)
    found.add(ids, firsts, codes)
    found.flush()
    # Every stretch of 20,000 terms has four neighbours for each term, but six less at its ends.
    pairs = 30 * (4 * 20_000 - 6)
    shape = found.sums[quality._bucket(b"s", b"x")]
    assert shape[[0, 1, 2, 63]].tolist() == [-2 * pairs, 2 * pairs, 0, -2 * pairs]
    words = found.sums[quality._bucket(b"w", b"a")] + found.sums[quality._bucket(b"w", b"b")]
    assert np.array_equal(words, shape)


def test_pooling_looks_terms_up_once_and_not_at_each_occurrence():
    looked_up = []

    class Counting(Interner):
        def __getitem__(self, term):
            looked_up.append(term)
            return super().__getitem__(term)

    vectors = np.random.default_rng(0).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    texts = [b"Plain words, and more; \xc3\xa9t\xc3\xa9 " * 50, b"", b"plain 12 \xc3\xa9t\xc3\xa9"]
    got = quality.pooled(texts, vectors, Counting(quality._word_and_shape))
    assert sorted(looked_up) == [b",", b";", b"\xc3\xa9t\xc3\xa9"]
    for row, text in zip(got, texts, strict=True):
        w, s = np.divmod(np.array(_plain_codes(text), int), quality.BUCKETS)
        plain = np.concatenate([vectors[w].sum(axis=0), vectors[s].sum(axis=0)]) / max(1, len(w))
        assert row == pytest.approx(plain, abs=1e-5)

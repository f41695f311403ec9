"""The trie against plain dictionaries, and scores against a plain model."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cinderlake.llm.common import id_crc
from cinderlake.llm.eliasfano import EliasFano, NgramTrie
from cinderlake.llm.language_model import score


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=200))
def test_sequences(values):
    values = np.array(sorted(values))
    parts, width = EliasFano.parts(values, 5001)
    assert EliasFano(*parts, width)[np.arange(len(values))].tolist() == values.tolist()


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.tuples(*[st.integers(0, 6)] * 3), max_size=60),
    st.lists(st.tuples(*[st.integers(0, 6)] * 3), min_size=1, max_size=60),
)
def test_trie(stored, asked):
    grams = np.array(sorted(stored), np.int64).reshape(-1, 3)
    trie = NgramTrie(grams, np.arange(len(grams), dtype=np.uint16), 7)
    place = {g: i for i, g in enumerate(sorted(stored))}
    assert trie.find(np.array(asked, np.int64)).tolist() == [place.get(g, -1) for g in asked]


def plain(rows, order, strength):
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows]
    texts = [[*(t or "").lower().split(), 1] for _, t in rows]
    counts = [Counter() for _ in range(order)]
    contexts = [Counter() for _ in range(order)]
    for t, h in zip(texts, held, strict=True):
        for i in range(len(t)):
            for k in range(order):
                if not h and (k == 0 or i >= k - 1):
                    gram = tuple([0, *t][i + 1 - k : i + 2])
                    counts[k][gram] += 1
                    contexts[k][gram[:-1]] += 1
    n, v = sum(counts[0].values()), len(counts[0])
    out = []
    for (doc_id, _), t, h in zip(rows, texts, held, strict=True):
        total = 0.0
        for i, w in enumerate(t):
            p = (counts[0][(w,)] - 0.75) / n if counts[0][(w,)] else (0.75 * v / n if n else 1.0)
            for k in range(1, order):
                if i >= k - 1:
                    gram = tuple([0, *t][i + 1 - k : i + 2])
                    p = (counts[k][gram] + strength * p) / (contexts[k][gram[:-1]] + strength)
            total += math.log10(p)
        base = sum(math.log10((counts[0][(w,)] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        known = sum(counts[0][(w,)] > 0 for w in t)
        out.append((doc_id, h, len(t), known, n, base, total))
    return out


@pytest.mark.parametrize("order,shard_tokens", [(1, 1000), (2, 2_000_000), (2, 50), (3, 300)])
def test_scores(spark, order, shard_tokens):
    rng = np.random.default_rng(1)
    vocabulary = [f"W{i}" for i in range(60)]
    rows = [
        (i, " ".join(rng.choice(vocabulary, rng.integers(0, 40)) if i % 3 else ["a", "b"] * 20))
        for i in range(120)
    ]
    rows += [(500, None), (501, ""), (None, "w1 W2"), (7, rows[7][1]), (502, "new\x0bwords é")]
    docs = spark.createDataFrame(
        [(*r, 1.0) for r in rows], "doc_id long, text string, score double"
    ).repartition(4)
    got = score(docs, id_crc() % 10 == 0, order, 4.0, shard_tokens).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
    got = sorted(map(tuple, got.collect()), key=str)
    want = sorted(plain(rows, order, 4.0), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-9)
        assert g[6] == pytest.approx(w[6], abs=4e-4 * g[2] * order)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score(docs, id_crc() % 10 == 0).collect() == []

"""The prefix-tree join against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cinderlake.llm import jaccard
from cinderlake.llm.jaccard import jaccard_components, linking_pairs


def roots(count, pairs):
    label = list(range(count))
    for _ in range(count):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def brute(sets, num, den):
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.frozensets(st.integers(0, 14), min_size=1), unique=True, max_size=30),
    st.sampled_from([(1, 2), (4, 5), (9, 10), (1, 1)]),
)
def test_tree_finds_all_components(sets, threshold):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = linking_pairs(arrays, *threshold)
    assert set(map(frozenset, got)) <= set(map(frozenset, brute(sets, *threshold)))
    assert roots(len(sets), got) == roots(len(sets), brute(sets, *threshold))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 400), min_size=100, max_size=300), unique=True,
                min_size=2, max_size=12), st.integers(0, 6), st.randoms())
def test_holders_stay_connected_however_pairs_are_cut(bases, edits, rng):
    """Sets that link are connected, with one pair at a time and bitmaps of several widths."""
    sets = []
    for base in bases:
        for _ in range(4):
            gone = set(rng.sample(sorted(base), min(edits, len(base) - 1)))
            sets.append(base - gone)
    arrays = [np.sort(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in sets]
    rows = np.arange(len(sets))
    zero = np.zeros(len(sets), np.int64)
    held, jaccard._PAIRS_AT_ONCE = jaccard._PAIRS_AT_ONCE, 1
    try:
        a, b = jaccard.connect_holders(
            zero, zero, zero > 0, rows, np.array([len(x) for x in arrays]),
            [jaccard.bitmap(x, 80, 100) for x in arrays], 80, 100,
        )
    finally:
        jaccard._PAIRS_AT_ONCE = held
    got = roots(len(sets), list(zip(a.tolist(), b.tolist(), strict=True)))
    assert all(got[i] == got[j] for i, j in brute(sets, 80, 100))


def shingles(text, n):
    w = (text or "").lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def expected(rows, n, num, den):
    sets = [shingles(t, n) if i is not None else frozenset() for i, t in rows]
    pairs = [
        (i, j) for i, j in brute(sets, num, den) if sets[i] and sets[j]
    ]
    first = roots(len(rows), pairs)
    return sorted(
        ((i, len(shingles(t, n)), None if i is None else min(rows[k][0] for k in range(len(rows))
          if first[k] == first[p] and rows[k][0] is not None))
         for p, (i, t) in enumerate(rows)), key=str,
    )


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    out = []
    for base in range(25):
        words = rng.choices(vocabulary, k=rng.choice([2, 4, 30, 80, 150]))
        if base % 3 == 0:
            words = words + passage
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    out += ["", None, "   ", "One", "one", "one two", "One  TWO\n"]
    rng.shuffle(out)
    return [(i * 7 % 1009, t) for i, t in enumerate(out)] + [(None, out[0])]


@pytest.mark.parametrize(
    "n,num,family_shingles,holders",
    [(3, 90, 500_000, 4096), (3, 90, 300, 3), (5, 80, 500_000, 2), (5, 80, 1, 4096)],
)
def test_components(spark, rows, n, num, family_shingles, holders):
    docs = spark.createDataFrame(
        [(*r, "x") for r in rows], "doc_id long, text string, component_id string"
    ).repartition(3)
    got = jaccard_components(docs, n, num, 100, family_shingles, holders)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, n, num, 100)


def test_large_group_of_variants(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(600):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            copy[rng.randrange(120)] = f"x{i}_{rng.random()}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(docs, 3, 90, 100)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, 90, 100)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(docs).collect() == []


@pytest.mark.parametrize("most", [200_000, 0])
def test_a_rare_shingle_with_very_many_holders(spark, rows, monkeypatch, most):
    """Shingles that are rare in every batch and held by many all the same; by broadcast and by shuffle."""
    monkeypatch.setattr(jaccard, "HELD_TOGETHER", 3)
    monkeypatch.setattr(jaccard, "_COMMON_IN_BATCH", 1000)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", most)
    windows = []
    plain = jaccard.Window.partitionBy
    monkeypatch.setattr(jaccard.Window, "partitionBy", lambda *c: windows.append(c) or plain(*c))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = jaccard_components(docs, 3, 90, 100, 500_000, 2)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, 90, 100)
    assert windows  # the rare ones still go through a window

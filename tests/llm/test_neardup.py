"""Near-duplicate vectors against brute force."""

from fractions import Fraction

import numpy as np
import pytest

from cinderlake.llm.neardup import (
    BLOCK,
    hash_codes,
    links_exactly,
    most_unlike,
    near_duplicates,
    pack_vector,
    sketches,
    unpack_vectors,
)


def brute(ids, rows, threshold=0.95):
    usable = [
        k for k, r in enumerate(rows)
        if ids[k] is not None and r and None not in r and np.isfinite(r).all() and any(r)
    ]
    unit = {}
    for k in usable:
        row = np.array(rows[k], float) / np.abs(rows[k]).max()
        unit[k] = row / np.linalg.norm(row)
    links = {
        k: [j for j in usable if j != k and len(rows[j]) == len(rows[k])
            and unit[k] @ unit[j] >= threshold]
        for k in usable
    }
    label = {k: ids[k] for k in usable}
    for _ in usable:
        for k in usable:
            for j in links[k]:
                label[k] = label[j] = min(label[k], label[j])
    return [(i, len(links.get(k, [])), label.get(k, i), i == label.get(k, i))
            for k, i in enumerate(ids)]


@pytest.mark.parametrize("block", [BLOCK, 7])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for size in (1, 1, 1, 3, 10, 40):
        for _ in range(4):
            centre = rng.normal(size=32)
            rows += [(centre + rng.normal(size=32) * 0.12).tolist() for _ in range(size)]
            rows += [(centre * 2).tolist(), (centre * 2).tolist()]
    rows += [None, [], [0.0] * 32, [float("nan")] * 32, [None] + [1.0] * 31, [1.0] * 5]
    rows += [[float("inf")] * 32, [1e200] * 32, [1e-200] * 32]
    ids = [int(i) for i in rng.permutation(len(rows))] + [None]
    rows.append(rows[0])
    data = [(i, r, "x") for i, r in zip(ids, rows, strict=True)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, n_links string")
    got = near_duplicates(frame.repartition(4), block=block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(ids, rows), key=str)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_recall_of_random_pairs_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(2000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    x, y = hash_codes(a), hash_codes(b)
    found = (x == y[:, :, :1]).any(axis=(1, 2)) | (y == x[:, :, :1]).any(axis=(1, 2))
    assert found.mean() > 0.99


def cosine_is_at_least(a, b, limit=Fraction(19, 20)):
    a, b = [Fraction(v) for v in a], [Fraction(v) for v in b]
    dot = sum(x * y for x, y in zip(a, b, strict=True))
    return dot > 0 and dot * dot >= limit * limit * sum(x * x for x in a) * sum(y * y for y in b)


def test_nothing_below_the_threshold_and_nothing_lost_at_it(spark):
    pairs = [([20.0, 0.0], [19.0, float(np.sqrt(39)) + step]) for step in (-1e-12, -1e-13, 0.0, 1e-13, 1e-12)]
    pairs += [([1.0, 0.0], [0.95, float(np.sqrt(1 - 0.95**2)) + step]) for step in (-2e-13, 0.0, 2e-13)]
    # 0.95 itself: (1, 0, 0, 0) and (19, 1, 1, 6, ...) with 400 = 361 + 39.
    pairs.append(([1.0, 0.0, 0.0, 0.0, 0.0], [19.0, 1.0, 1.0, 1.0, 6.0]))
    said = [cosine_is_at_least(a, b) for a, b in pairs]
    assert said[-1] and len(set(said[:5])) == 2
    for (a, b), link in zip(pairs, said, strict=True):
        rows = [(1, a), (2, b), (3, [-x for x in a])]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(frame).collect()}
        assert got == {1: (int(link), 1), 2: (int(link), 1 if link else 2), 3: (0, 3)}, (a, b)
        assert links_exactly(np.array(a), np.array(b), 0.95) == link


def test_packed_vectors():
    singles, doubles = [0.5, -3.0, 0.0], [0.1, -3.0, 0.0]
    assert len(pack_vector(singles)) == 13 and len(pack_vector(doubles)) == 25
    assert pack_vector(singles) == pack_vector([1.0, -6.0, -0.0]) == pack_vector([v / 64 for v in singles])
    rows = unpack_vectors([pack_vector(singles), pack_vector(doubles)])
    assert (rows * 4 == [singles, doubles]).all()
    assert [pack_vector(v) for v in (None, [], [0.0], [None], [float("inf")], [float("nan")])] == [None] * 6
    assert pack_vector([1e308, 1e-308]) is not None


def test_sketches_lose_next_to_no_pair():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(4000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    unlike = np.bitwise_count(sketches(a).view(np.uint64) ^ sketches(b).view(np.uint64))
    assert unlike.max() <= most_unlike(0.95) < 24
    others = np.bitwise_count(sketches(a).view(np.uint64) ^ sketches(np.roll(a, 1, axis=0)).view(np.uint64))
    assert (others <= most_unlike(0.95)).mean() < 0.01
    assert most_unlike(1.0) == 0 and most_unlike(-1.0) == 64


@pytest.mark.parametrize("block", [BLOCK, 64])
def test_pairs_planted_among_given_vectors(spark, block):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rng = np.random.default_rng(7)
    rows = [(r.vec_id, r.embedding) for r in given]
    for k in range(600):  # around the threshold, near it and far above it
        base = np.array(rows[k % 150][1])
        noise = rng.normal(size=len(base)) / np.sqrt(len(base)) * np.linalg.norm(base)
        rows.append((10_000 + k, (base + noise * rng.choice([0.05, 0.2, 0.33])).astype(np.float32).tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    got = {r.vec_id: r for r in near_duplicates(frame, block=block).collect()}
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    found, there = sum(r.n_links for r in got.values()), int(link.sum())
    assert there > 1500 and found <= there and found >= 0.99 * there
    assert all(got[i].n_links <= n for i, n in zip(ids.tolist(), link.sum(axis=1), strict=True))
    label = ids.copy()
    while True:
        low = np.where(link, label, label.max()).min(axis=1)
        low = np.minimum(label, low)
        if (low == label).all():
            break
        label = low
    assert np.mean([got[i].component_id == c for i, c in zip(ids.tolist(), label, strict=True)]) > 0.99

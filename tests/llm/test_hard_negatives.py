"""Residue arithmetic against 64-bit products, hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderlake.llm import hard_negatives
from cinderlake.llm.hard_negatives import mine
from cinderlake.llm.residues import primes_for, products, residues

SCHEMA = "score string, label int, embedding array<double>, vec_id long, row int"


def brute(rows, anchors=50, positives=5, negatives=3):
    """rows: (vec_id, label, vector), usable ones only."""
    whole = [[int(np.floor(256 * c)) for c in r[2]] for r in rows]
    out = []
    for a, (anchor, label, _) in enumerate(rows):
        if anchor % anchors:
            continue
        scored = [
            (-sum(x * y for x, y in zip(whole[a], whole[k], strict=True)), r[0], r[1] == label)
            for k, r in enumerate(rows)
        ]
        near = sorted((s, i) for s, i, same in scored if same and i != anchor)[:positives]
        for p, positive in near:
            far = sorted(
                (s, i) for s, i, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p
            )
            for k, (s, i) in enumerate(far[:negatives], 1):
                out.append((anchor, positive, k, i, -p, -s))
    return sorted(out)


def run(spark, rows, parts=3, **more):
    given = spark.createDataFrame([("x", r[1], r[2], r[0], 0) for r in rows], SCHEMA)
    found = mine(given.repartition(parts), F.col("vec_id") % 50 == 0, **more)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("width,top", [(1, 5), (64, 300), (64, 1 << 20), (700, 1 << 12)])
def test_products_are_exact(width, top):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-top, top + 1, (7, width)), rng.integers(-top, top + 1, (9, width))
    a[0], b[0] = top, -top
    bound = int(max((a * a).sum(axis=1).max(), (b * b).sum(axis=1).max()))
    primes = primes_for(width, bound)
    assert all(width * ((p - 1) // 2) ** 2 < 1 << 24 for p in primes) and len(set(primes)) == len(primes)
    assert (products(residues(a, primes), residues(b, primes), primes) == a @ b.T).all()


def test_no_primes_for_very_long_vectors():
    with pytest.raises(ValueError, match="too long"):
        primes_for(1 << 22, 1 << 40)


def vectors(rng, n, width=16, labels=4, spread=0.3):
    centres = rng.normal(size=(5, width))
    rows = centres[rng.integers(0, 5, n)] + rng.normal(size=(n, width)) * spread
    return [(k, int(rng.integers(0, labels)), r.tolist()) for k, r in enumerate(rows)]


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = vectors(rng, 400)
    want = brute(rows)
    assert len(want) > 50 and run(spark, rows) == want
    # Many blocks of anchors, many parts of rows, several blocks of scores.
    monkeypatch.setattr(hard_negatives, "_HELD", 16 * 3)
    monkeypatch.setattr(hard_negatives, "_LEAST_ROWS", 30)
    monkeypatch.setattr(hard_negatives, "_MOST_ROWS", 60)
    assert run(spark, rows, 11) == want


def test_ties_and_equal_vectors(spark):
    rng = np.random.default_rng(1)
    few = [rng.integers(-2, 3, 4).astype(float).tolist() for _ in range(6)]
    rows = [(k, k % 2, few[int(rng.integers(0, 6))]) for k in range(300)]
    rows += [(1000, 0, few[0]), (1050, 1, [0.0] * 4)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = vectors(rng, 120)
    bad = [(200, 1, None), (250, None, rows[0][2]), (None, 1, rows[0][2]), (300, 1, []),
           (350, 2, [None] * 16), (400, 2, [float("nan")] * 16), (450, 2, [float("inf")] * 16),
           (500, 2, [1.0, 2.0])]
    assert run(spark, rows + bad) == brute(rows)
    assert run(spark, bad) == [] and run(spark, rows[1:40]) == []


def test_repeated_ids(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 101)
    rows += [rows[0], rows[7], (0, (rows[0][1] + 1) % 4, rows[1][2])]
    assert run(spark, rows) == brute(rows)


def test_one_label_holds_most_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, 0 if i % 3 else v, r) for i, v, r in vectors(rng, 300)]
    monkeypatch.setattr(hard_negatives, "_LEAST_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "_MOST_ROWS", 40)
    assert run(spark, rows) == brute(rows)


def test_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v, (np.array(r) * 3000).tolist()) for i, v, r in vectors(rng, 150)]
    assert run(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="too l"):
        run(spark, rows + [(900, 1, [1e9] * 16)])

"""Whitening by polarisation against exact arithmetic and numpy."""

from fractions import Fraction

import numpy as np
import pytest

from cinderlake.llm import whitening
from cinderlake.llm.queries import QUERIES
from cinderlake.llm.whitening import Moments, column_sums, fit, square_sums, whiten

SCHEMA = "embedding array<double>, vec_id long, whitened string, n int"
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(r, i, "theirs", 1) for i, r in rows], SCHEMA)


def exact(rows, scale=1024, shift=100_000):
    x = [[int(np.floor(scale * c)) + shift for c in r] for r in rows]
    n, width = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(width)]
    scatter = [
        [sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) for j in range(width)]
        for i in range(width)
    ]
    # Sums of products of n*x - S are n^3 times the covariance.
    covariance = np.array([[float(Fraction(v, n**3)) for v in row] for row in scatter])
    deviation = [sum((n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    return np.array(x, float), n, sums, covariance, deviation


def check(got, ids, rows, components=8):
    x, n, sums, covariance, deviation = exact(rows)
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    assert len(got) == len(rows) * min(components, x.shape[1])
    found = {(r.vec_id, r.component): r for r in got}
    for k in range(len(values)):
        want = (x - np.array(sums) / n) @ basis[:, k] / np.sqrt(values[k])
        have = np.array([found[i, k + 1].whitened for i in ids])
        assert np.allclose(have * np.sign(have @ want), want, atol=1e-7)
        assert found[ids[0], k + 1].explained == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
    for i, d in zip(ids, deviation, strict=True):
        assert found[i, 1].deviation == d and found[i, 1].n == n
    assert all(r.identity_error < 1e-9 for r in got)


def test_against_exact_covariance(spark):
    rng = np.random.default_rng(0)
    rows = (rng.normal(size=(300, 12)) @ np.diag(np.linspace(2, 0.1, 12)) + 5).tolist()
    got = whiten(frame(spark, list(enumerate(rows))).repartition(7)).collect()
    check(got, list(range(300)), rows)


def test_rows_that_are_left_out_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(20, 3)).tolist()
    good = list(enumerate(rows))
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]),
           (94, [1.0, 2.0, float("-inf")]), (95, [1.0, 2.0]), (None, None)]
    check(whiten(frame(spark, good + bad)).collect(), list(range(20)), rows)
    # A repeated row counts twice, and a row without an id keeps its NULL.
    got = whiten(frame(spark, good + [(0, rows[0]), (None, rows[1])])).collect()
    assert len(got) == 22 * 3 and {r.n for r in got} == {22}
    assert sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 0 for r in got) == 6


def test_no_variance_and_no_rows(spark):
    got = whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0])])).collect()
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, True)}
    assert all(r.identity_error < 1e-12 for r in got)
    one = whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in one] == [(None, 0.0, 0)] * 2
    none = whiten(frame(spark, [(1, None)]))
    assert none.collect() == [] and none.columns == whiten(frame(spark, [(1, [1.0])])).columns


def test_sums_beyond_double_precision():
    rng = np.random.default_rng(2)
    big = rng.integers(-(1 << 60), 1 << 60, (50, 4))
    assert column_sums(big) == [sum(int(v) for v in c) for c in big.T]
    z = [[int(v) for v in r] for r in big]
    want = []
    for i in range(4):
        want.append(sum(r[i] ** 2 for r in z))
        want += [sum((r[i] + r[j]) ** 2 for r in z) for j in range(i + 1, 4)]
    assert square_sums(big).tolist() == want
    small = rng.integers(-900, 900, (50, 4))
    assert square_sums(small).tolist() == square_sums(small.astype(object)).tolist()


def test_cancellation_does_not_hurt(spark):
    # A spread of one part in a thousand million about a large mean.
    rows = [[1e6 + (k % 2) / 1024, 1e6 + (k % 3) / 1024] for k in range(60)]
    check(whiten(frame(spark, list(enumerate(rows)))).collect(), list(range(60)), rows, 2)


def test_deviation_beyond_64_bits():
    found = Moments(10**9, [0, 0], [[1, 0], [0, 1]])
    x = np.array([[2000, -1500]])
    assert whitening.deviations(x, found).to_pylist() == [(2000**2 + 1500**2) * 10**18]
    assert fit(found, 8).values.shape == (2,)


def test_too_large_an_entry(spark):
    with pytest.raises(Exception, match="too large"):
        whiten(frame(spark, [(1, [1e30]), (2, [1.0])])).collect()


def test_query_over_its_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = QUERIES["op11_embedding_whitening"](spark, SMALL)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), [r.vec_id for r in table], [r.embedding for r in table])

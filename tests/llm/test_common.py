"""What the operators share: bounded caches, parts of batches, memory that goes back."""

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.llm.common import ARROW_ROWS, Interner, parts_of, released, short_batches
from cinderlake.llm.vectors import matrices


def test_a_cache_is_bounded_by_bytes():
    made = []
    known = Interner(lambda w: made.append(w) or len(w), most=10_000)
    words = [b"w%d" % k for k in range(200)] + [b"x" * 4000, b"y" * 4000, b"z" * 50_000]
    for _ in range(3):
        assert [known[w] for w in words] == [len(w) for w in words]
        assert sum(len(w) + Interner._EACH for w in known) <= 50_000 + Interner._EACH
    few = Interner(len)
    assert [few[w] for w in words[:5] * 2] == [2, 2, 2, 2, 2] * 2 and len(few) == 5


@pytest.mark.parametrize("kind", [pa.string(), pa.binary()])
def test_parts_hold_all_rows_in_order(kind):
    texts = ["a" * n for n in (3, 0, 50, 9, 9, 9, 700)] + [None, "", None] + ["b"] * 1200
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts).cast(kind)], names=["n", "text"]
    )
    parts = list(parts_of([batch, batch.slice(0, 0), batch.slice(2, 5)], "text", most=40))
    assert [v for p in parts for v in p.column("n").to_pylist()] == [*range(len(texts)), *range(2, 7)]
    for p in parts:
        sizes = [len(v or "") for v in p.column("text").to_pylist()]
        assert len(p) <= 512 and sum(sizes[:-1]) < 40


def test_released_passes_rows_and_errors_on():
    assert list(released(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4]

    def broken(batches):
        yield next(batches)
        raise ValueError("no")

    found = released(broken)(iter([1]))
    assert next(found) == 1
    with pytest.raises(ValueError, match="no"):
        next(found)


def test_short_batches_keep_a_smaller_bound(spark):
    before = spark.conf.get(ARROW_ROWS)
    try:
        for given, want in (("10000", "2000"), ("500", "500"), ("0", "2000"), ("-1", "2000")):
            spark.conf.set(ARROW_ROWS, given)
            short_batches(spark)
            assert spark.conf.get(ARROW_ROWS) == want
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_matrices_of_lists_with_gaps():
    lists = [[1.0, 2.0], None, [3.0], [4.0, None], [5.0, 6.0], [], [float("nan"), 1.0], [7.0, float("inf")]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(8)), pa.array(lists, pa.list_(pa.float32()))], names=["vec_id", "v"]
    )
    for given, ids in ((batch, [0, 4]), (batch.slice(3), [4]), (batch.slice(1, 2), [])):
        found = list(matrices([given], "v", 2))
        assert [i for rows, _ in found for i in rows.column("vec_id").to_pylist()] == ids
        assert all(m.dtype == np.float64 and m.shape[1] == 2 for _, m in found)

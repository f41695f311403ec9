from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinderlake.operators.keyed import (
    assign_surrogate_keys,
    distinct_dimension,
    first_per_key,
    insert_if_absent,
)

# Both ways to find conflicts: by broadcast of the incoming keys, and by shuffle.
WAYS = {"broadcast": {}, "shuffle": {"max_broadcast_bytes": 0}}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_distinct_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 1, 6), ("a", 1, 7)], "d string, c int, x int")
    assert rows(distinct_dimension(df, ["d", "c"])) == [("a", 1), (None, 1)]


def test_first_per_key_follows_the_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, "q"), (None, 3, "n"), (None, 4, "m")],
        "k string, o int, v string",
    )
    assert rows(first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 9, "q"), (None, 3, "n")]
    assert rows(first_per_key(df, ["k"], [F.desc("o")])) == [
        ("a", 2, "x"),
        ("b", 9, "q"),
        (None, 4, "m"),
    ]


def test_first_per_key_with_keys_only(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(first_per_key(df, ["k"])) == [("a",), ("b",)]


@pytest.mark.parametrize("way", WAYS)
def test_insert_if_absent_by_hand(spark, way):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame(
        [(1, "new"), (2, "b"), (2, "a"), (None, "n"), (None, "n")], "k int, v string"
    )
    fresh = insert_if_absent(target, incoming, ["k"], **WAYS[way])
    assert rows(fresh) == [(2, "a"), (None, "n"), (None, "n")]
    fresh = insert_if_absent(target, incoming, ["k"], null_keys="drop", **WAYS[way])
    assert rows(fresh) == [(2, "a")]


@pytest.mark.parametrize("way", WAYS)
def test_null_in_a_primary_key_is_an_error(spark, way):
    target = spark.createDataFrame([], "k long, v string")
    incoming = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    with pytest.raises(Exception, match="NULL in column k"):
        insert_if_absent(target, incoming, ["k"], null_keys="error", **WAYS[way]).collect()
    with pytest.raises(ValueError, match="null_keys"):
        insert_if_absent(target, incoming, ["k"], null_keys="ignore")


@pytest.mark.parametrize("way", WAYS)
def test_two_column_keys(spark, way):
    target = spark.createDataFrame([(1, 1, "t")], "a int, b int, v string")
    incoming = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "y"), (1, None, "z"), (1, None, "z")], "a int, b int, v string"
    )
    fresh = insert_if_absent(target, incoming, ["a", "b"], **WAYS[way])
    assert rows(fresh) == [(1, 2, "y"), (1, None, "z"), (1, None, "z")]


@pytest.mark.parametrize("way", WAYS)
def test_a_key_with_a_third_of_the_rows(spark, way):
    ids = spark.range(30_000)
    incoming = ids.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    target = ids.where("id < 100").select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    fresh = insert_if_absent(target, incoming, ["k"], **WAYS[way])
    expected = {i for i in range(100, 30_000) if i % 3}
    assert rows(fresh) == sorted(((i, i) for i in expected), key=str)


@settings(max_examples=8, deadline=None)
@given(
    batch=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)), max_size=12),
    cut=st.integers(0, 12),
)
def test_any_split_of_a_batch_gives_the_same_keys(spark, batch, cut):
    kind = "k int, v int"
    empty = spark.createDataFrame([], kind)

    def insert(table, part):
        return table + rows(
            insert_if_absent(spark.createDataFrame(table, kind), spark.createDataFrame(part, kind), ["k"])
        )

    whole = rows(insert_if_absent(empty, spark.createDataFrame(batch, kind), ["k"]))
    split = insert(insert([], batch[:cut]), batch[cut:])
    assert Counter(k for k, _ in whole) == Counter(k for k, _ in split)
    assert insert(split, [b for b in batch if b[0] is not None]) == split


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_surrogate_keys_are_dense_and_in_key_order(spark, n):
    df = spark.range(0, n, 1, 5).select((F.lit(n) - F.col("id")).alias("k"), F.col("id").alias("v"))
    numbered = assign_surrogate_keys(df, ["k"], "sk", after=10)
    assert numbered.columns == ["sk", "k", "v"]
    assert rows(numbered) == sorted(((10 + k, k, n - k) for k in range(1, n + 1)), key=str)
    assert len({r.sk for r in numbered.collect()}) == n


def test_both_ways_of_numbering_give_the_same(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 1009).alias("k"), F.lit("x").alias("v"))
    few = assign_surrogate_keys(df, ["k"], "sk", 40, count=500)
    many = assign_surrogate_keys(df, ["k"], "sk", 40)
    assert rows(few) == rows(many)

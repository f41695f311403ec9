"""Frames side by side."""

import pytest
from pyspark.sql import functions as F

from cinderlake.operators.sideways import lay_side_by_side, repeats_side_by_side


def test_frames_of_different_lengths(spark):
    a = spark.range(7).select((F.col("id") * 3 % 7).alias("a")).repartition(3)
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "b string, `b two` int")
    c = spark.createDataFrame([], "c double")
    got = lay_side_by_side([a, b, c], [["a"], [F.desc("b two")], []])
    assert got.columns == ["a", "b", "b two", "c"]
    assert [tuple(r) for r in got.orderBy("a").collect()] == [
        (0, "y", 3, None), (1, None, 2, None), (2, "x", 1, None), *[(n, None, None, None) for n in range(3, 7)]
    ]


def test_rows_keep_the_order_of_their_partitions(spark):
    a = spark.range(0, 100, 1, 5).toDF("a")
    b = spark.range(0, 300, 1, 3).select((F.col("id") * 2).alias("b")).where("b < 100")
    got = sorted((r.a, r.b) for r in lay_side_by_side([a, b]).collect())
    assert got == [(n, 2 * n if n < 50 else None) for n in range(100)]


def test_one_frame_and_errors(spark):
    a = spark.range(3).toDF("a")
    assert lay_side_by_side([a]).count() == 3
    with pytest.raises(ValueError, match="more than one frame"):
        lay_side_by_side([a, a])
    with pytest.raises(ValueError, match="no frames"):
        lay_side_by_side([])
    with pytest.raises(ValueError, match="orders"):
        lay_side_by_side([a], [["a"], ["a"]])


def test_each_frame_is_shuffled_once_and_nothing_is_sorted_in_one_task(spark, plan_text):
    frames = [spark.range(1000).toDF(c) for c in "abc"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(lay_side_by_side(frames))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_place") == 4  # the places and three frames
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # The only rows that meet in one task are those of the partitions' sizes.
    assert plan.count("Exchange SinglePartition") == 3


def test_repeats_in_their_own_types(spark):
    rows = [(1, "a", 1.5), (1, "b", None), (2, "a", None), (1, "c", 2.0), (2, "a", None), (3, "d", 2.0)]
    got = repeats_side_by_side(
        spark.createDataFrame(rows, "k long, name string, price double").repartition(4), ["k", "name", "price"]
    )
    assert got.columns == ["k", "k_count", "name", "name_count", "price", "price_count"]
    assert dict(got.dtypes)["price"] == "double" and dict(got.dtypes)["k"] == "bigint"
    assert [tuple(r) for r in got.orderBy(F.asc_nulls_last("k")).collect()] == [
        (1, 3, "a", 3, None, 3), (2, 2, None, None, 2.0, 2)
    ]
    nothing = repeats_side_by_side(spark.range(5), ["id"])
    assert nothing.columns == ["id", "id_count"] and nothing.count() == 0
    assert repeats_side_by_side(spark.range(5), []).columns == []

import pytest
from pyspark.sql import functions as F

from cinderlake.operators.joins import Dimension, fits_broadcast, lookup_dimensions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("limit", [None, 0])
def test_lookup_by_hand(spark, limit):
    fact = spark.createDataFrame(
        [(1, "B1", "X"), (2, "B2", None), (3, None, "X"), (4, "B9", "Y")], "id int, b string, d string"
    )
    battalions = spark.createDataFrame([(10, "B1"), (20, "B2")], "b_sk long, b string")
    districts = spark.createDataFrame([(7, "X"), (8, None)], "d_sk long, d string")
    options = {} if limit is None else {"max_broadcast_bytes": limit}
    found = lookup_dimensions(
        fact, [Dimension(battalions, "b", "b_sk"), Dimension(districts, "d", "d_sk")], **options
    )
    assert rows(found.select("id", "b", "b_sk", "d", "d_sk")) == [
        (1, "B1", 10, "X", 7),
        (2, "B2", 20, None, None),
        (3, None, None, "X", 7),
        (4, "B9", None, "Y", None),
    ]


def test_lookup_with_hot_missing_and_null_keys(spark):
    """A third of the rows has one key, a third has one unknown key, and many have none."""
    fact = spark.range(9000).select(
        "id",
        F.expr("CASE id % 6 WHEN 0 THEN 5 WHEN 1 THEN 5 WHEN 2 THEN -1 WHEN 3 THEN -1 WHEN 4 THEN NULL ELSE id END").alias("k"),
    )
    side = spark.range(8000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("sk"))
    dims = [Dimension(side, "k", "sk")]
    expected = rows(fact.join(side, "k", "left").select("id", "k", "sk"))
    assert rows(lookup_dimensions(fact, dims).select("id", "k", "sk")) == expected
    large = lookup_dimensions(fact, dims, max_broadcast_bytes=0)
    assert rows(large.select("id", "k", "sk")) == expected


def test_fits_broadcast_counts_text(spark):
    small = spark.createDataFrame([("a", 1)], "s string, n int")
    assert fits_broadcast(small, 1000)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 10_000).alias("s"))
    assert not fits_broadcast(wide, 100_000)
    assert fits_broadcast(wide, 200_000)
    assert not fits_broadcast(spark.range(1), rows=10**9)
    assert not fits_broadcast(spark.range(1).select(F.array("id")))


def test_large_lookup_does_not_shuffle_hot_rows(spark, plan_text):
    fact = spark.range(1_000_000).select("id", (F.col("id") % 7).alias("k"))
    side = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("sk"))
    plan = plan_text(lookup_dimensions(fact, [Dimension(side, "k", "sk")], max_broadcast_bytes=0))
    assert "TakeOrderedAndProject(limit=200" in plan
    assert "SortMergeJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan

"""Insert-if-absent into bucketed tables, and that these are not shuffled for it."""

import pytest
from pyspark.sql import functions as F

from cinderlake.operators.keyed import insert_if_absent
from cinderlake.schemas import struct
from cinderlake.sources.bucketed import BucketedTable, buckets_for

SCHEMA = struct("k long\npart int\nv string")


@pytest.fixture
def target(spark, tmp_path):
    table = BucketedTable(spark, f"t_{tmp_path.name}", str(tmp_path / "it's here"), SCHEMA, ["k", "part"], 8)
    table.create()
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def rows(spark, low, high):
    return spark.range(low, high).selectExpr("id % 700 AS k", "CAST(id % 2 AS int) AS part", "CAST(id AS string) AS v")


def test_inserts_as_the_plain_operator_does(spark, target):
    first, second = rows(spark, 0, 900), rows(spark, 500, 1500)
    plain = insert_if_absent(spark.createDataFrame([], SCHEMA), first, ["k", "part"], ["v"], "drop")
    assert target.insert(first, ["v"]) == plain.count()
    added = insert_if_absent(plain, second, ["k", "part"], ["v"], "drop")
    assert target.insert(second, ["v"]) == added.count()
    assert target.insert(second, ["v"]) == 0
    want = plain.unionByName(added)
    assert sorted(map(tuple, target.read().collect())) == sorted(map(tuple, want.collect()))


def test_null_keys_hot_keys_and_empty_frames(spark, target):
    hot = spark.range(5000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "1 AS part", "CAST(id AS string) AS v"
    )
    keys = hot.where("k IS NOT NULL").select("k").distinct().count()
    assert target.insert(hot) == keys and target.read().where("k IS NULL").count() == 0
    assert target.insert(hot.limit(0)) == 0 and target.read().count() == keys


def test_the_target_is_not_shuffled(spark, target, plan_text):
    target.insert(rows(spark, 0, 900))
    target.insert(rows(spark, 500, 1500))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(target.new_keys(rows(spark, 0, 2000)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    held = join[join.index("Bucketed: true") - 1200 :]
    left, right = join.split("FileScan", 1)
    assert "Bucketed: true" in right and "Exchange" not in right
    # Above the scan of the target there is no exchange up to the join, only on the other side.
    above = left[left.rindex("Sort [") :]
    assert "Exchange" not in above and "Exchange" in left and held
    assert "v#" not in right.split("]")[0]  # the key columns alone are read
    # The keys are brought down to one per task before they move.
    assert left.count("HashAggregate") == 2


def test_a_session_that_does_not_know_the_table(spark, target, tmp_path):
    target.insert(rows(spark, 0, 100))
    spark.sql(f"DROP TABLE {target.name}")  # the files of a table with a place of its own stay
    target.attach()
    assert target.read().count() == 100
    assert target.insert(rows(spark, 50, 120)) == 20
    files = {f.name.split("_")[1][:5] for f in (tmp_path / "it's here").glob("*.parquet")}
    assert len(files) <= 8


def test_number_of_buckets():
    assert [buckets_for(n) for n in (0, 10**6, 4 * 10**7, 10**9, 10**11)] == [8, 8, 16, 256, 32768]


def test_rows_must_fit(spark, target):
    with pytest.raises(ValueError, match="do not fit"):
        target.append(spark.range(3))
    with pytest.raises(Exception, match="does not fit"):
        target.append(spark.range(3).select(F.lit("x").alias("k"), F.lit(1), F.lit("v")))
    assert target.read().count() == 0

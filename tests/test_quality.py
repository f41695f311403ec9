from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinderlake.operators.quality import (
    assert_no_repeats,
    constraint_report,
    drop_colliding_rows,
    find_repeated_values,
    max_values,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def survivors(data):
    """Brute force: rows of which no field's value occurs twice; None never collides."""
    counts = [Counter(r[i] for r in data) for i in range(2)]
    return sorted(
        (r for r in data if all(r[i] is None or counts[i][r[i]] == 1 for i in range(2))), key=str
    )


def test_all_members_of_a_collision_go(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, 3), (4, 4)], "a int, b int")
    assert rows(drop_colliding_rows(df, ["a", "b"])) == [(4, 4)]


def test_fields_are_judged_over_the_whole_frame(spark):
    """(2, 2) goes because of (1, 2), although that row goes itself."""
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (5, 6)], "a int, b int")
    assert rows(drop_colliding_rows(df, ["a", "b"])) == [(5, 6)]


def test_nulls_do_not_collide(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 2), (4, None), (None, None)], "a int, b int")
    assert rows(drop_colliding_rows(df, ["a", "b"])) == sorted(
        [(None, 1), (4, None), (None, None)], key=str
    )


def test_fields_of_different_types(spark):
    df = spark.createDataFrame([(1, "x", 0.0), (2, "x", 1.0), (3, "y", -0.0), (4, "z", 2.0)], "a int, b string, c double")
    assert rows(drop_colliding_rows(df, ["a", "b", "c"])) == [(4, "z", 2.0)]


def test_with_a_row_key(spark):
    df = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "r long, a int")
    assert rows(drop_colliding_rows(df, ["a"], row_key="r")) == [(12, 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 9))] * 2), max_size=12))
def test_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    assert rows(drop_colliding_rows(df, ["a", "b"])) == survivors(data)


def test_a_value_with_a_third_of_the_rows(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    )
    assert rows(drop_colliding_rows(df, ["a", "b"])) == sorted(
        ((i, i) for i in range(9000) if i % 3), key=str
    )


def test_repeated_values_report(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "y"), (2, "z")], "a int, b string")
    report = find_repeated_values(df, ["a", "b"])
    assert [tuple(r) for r in report.collect()] == [("a", "2", 3), ("a", "1", 2), ("b", "y", 3)]
    with pytest.raises(ValueError, match="repeated values"):
        assert_no_repeats(report)
    assert_no_repeats(find_repeated_values(df.limit(1), ["a", "b"]))


def test_values_of_unlike_types_are_compared_in_their_own(spark):
    """Two times an hour apart read alike at the end of daylight saving."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT n, timestamp_seconds(1730610000 + 3600 * n) AS t, CAST(n AS decimal(5,1)) AS d,"
            " CAST(CAST(n AS string) AS binary) AS b FROM VALUES (0), (1), (2), (2) AS v(n)"
        )
        kept = drop_colliding_rows(df, ["n", "t", "d", "b"])
        assert sorted(r.n for r in kept.collect()) == [0, 1]
        found = find_repeated_values(df, ["n", "t", "d", "b"]).collect()
        assert [(r.field, r["count"]) for r in found] == [("b", 2), ("d", 2), ("n", 2), ("t", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows_of_files_need_no_copy(spark, tmp_path):
    data = [(i % 7 or i, i if i % 5 else None) for i in range(60)]
    spark.createDataFrame(data, "a int, b int").repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    kept = drop_colliding_rows(df.where("a >= 0"), ["a", "b"])
    assert rows(kept) == survivors(data)
    # The files read are the table's own.
    assert all(str(tmp_path) in f for f in kept.inputFiles())
    # Where a row can come out twice, position in the file is no key.
    twice = df.select(F.explode(F.array("a", "a")).alias("a"), "b")
    assert drop_colliding_rows(twice, ["a", "b"]).count() == 0
    assert drop_colliding_rows(df.unionAll(df), ["a", "b"]).count() == 0


def test_max_values(spark):
    df = spark.createDataFrame([(1, 5), (3, None)], "a int, b int")
    assert rows(max_values(df, ["a", "b"])) == [(3, 5)]
    assert rows(max_values(df.where("a > 9"), ["a", "b"])) == [(0, 0)]


def test_max_values_refuses_what_is_no_number(spark):
    with pytest.raises(ValueError, match="not numeric.*'t'"):
        max_values(spark.createDataFrame([(1, "x")], "a int, t string"), ["a", "t"])


def test_report_without_constraints_is_empty(spark):
    assert constraint_report(spark.range(3)).collect() == []


def test_constraint_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (None, 2), (None, 2)], "a int, b int")
    report = constraint_report(df, unique=[["a", "b"], ["a"]], not_null=["a", "b"])
    assert rows(report) == [
        ("not_null", "a", 2),
        ("not_null", "b", 1),
        ("unique", "a", 1),
        ("unique", "a,b", 1),
    ]

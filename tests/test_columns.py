from datetime import datetime

import pytest

from cinderlake.operators.columns import (
    bind_columns,
    cast_columns,
    fill_nulls,
    load_by_position,
    map_strings,
    normalize_names,
    require_columns,
    require_values,
)
from cinderlake.schemas import struct


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Incident Number", "ID"])
    assert normalize_names(df).columns == ["incident_number", "id"]


def test_require_columns(spark):
    df = spark.createDataFrame([("a", "b")], ["neighborhood_district", "other"])
    assert require_columns(df, ["neighborhood_district"]) is df
    with pytest.raises(ValueError, match="city"):
        require_columns(df, ["neighborhood_district", "city"])


def test_bind_columns_wants_the_exact_set(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert bind_columns(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing"):
        bind_columns(df, ["a", "b", "c"])
    with pytest.raises(ValueError, match="unexpected"):
        bind_columns(df, ["a"])
    with pytest.raises(ValueError, match="repeated"):
        bind_columns(df.toDF("a", "a"), ["a"])


def test_load_by_position_renames_and_casts(spark):
    df = spark.createDataFrame([(1, "2")], ["x.y", "b"])
    loaded = load_by_position(df, struct("one double\ntwo long"))
    assert loaded.columns == ["one", "two"]
    assert loaded.first() == (1.0, 2)
    with pytest.raises(ValueError, match="do not fit"):
        load_by_position(df, struct("one double"))


def test_cast_columns_fails_on_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "2024-01-06T10:00:00")], ["n", "t"])
    schema = struct("n long\nt timestamp")
    assert cast_columns(df, schema).first() == (1, datetime(2024, 1, 6, 10))
    bad = spark.createDataFrame([("3.5x", None)], "n string, t string")
    with pytest.raises(Exception, match="column n does not fit bigint: 3.5x"):
        cast_columns(bad, schema).collect()


def test_casts_are_strict_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        bad = spark.createDataFrame([("3.5x", 2**40)], "n string, big long")
        with pytest.raises(Exception, match="column n does not fit bigint"):
            cast_columns(bad, struct("n long")).collect()
        with pytest.raises(Exception, match="column big does not fit int"):
            load_by_position(bad.select("big"), struct("small int")).collect()
        assert load_by_position(bad.select("big"), struct("kept long")).first() == (2**40,)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_map_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(" a ", 1, None)], "s string, n int, t string")
    assert map_strings(df).first() == ("A", 1, None)


def test_fill_nulls_touches_only_its_columns(spark):
    df = spark.createDataFrame([(None, None, None)], "a long, b double, c long")
    assert fill_nulls(df, ["a", "b"]).first() == (0, 0.0, None)


def test_require_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert require_values(df, ["a"]).collect() == df.collect()
    with pytest.raises(Exception, match="NULL in column b"):
        require_values(df, ["a", "b"]).collect()

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cinderlake.functions import draws
from cinderlake.functions.calendar import CALENDAR_COLUMNS, build_dim_date
from cinderlake.functions.text import WHITESPACE, clean_str, first_letter_acronym
from cinderlake.schemas import DIM_DATE_SCHEMA, names


def apply(spark, function, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r[0] for r in df.orderBy("n").select(function(F.col("v"))).collect()]


def test_clean_str_by_hand(spark):
    given = [" san francisco ", "Presidio\t", "straße", "", "   ", "a b", None]
    assert apply(spark, clean_str, given) == [
        "SAN FRANCISCO",
        "PRESIDIO",
        "STRASSE",
        "",
        "",
        "A B",
        None,
    ]


def test_clean_str_strips_what_python_strips(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(WHITESPACE) == blanks
    others = ["​", "﻿", "\x00"]
    given = [f"{b}a{b}b{b}" for b in blanks + others]
    assert apply(spark, clean_str, given) == [g.upper().strip() for g in given]


def test_acronym_by_hand(spark):
    given = ["SAN FRANCISCO", "SF", "TREASURE ISLA", "SAN DE XY", "A  B", "", " NEW YORK", None]
    assert apply(spark, first_letter_acronym, given) == [
        "SF",
        "SF",
        "TI",
        "SDEXY",
        "AB",
        "",
        "NY",
        None,
    ]


def test_calendar_schema_and_bounds(spark):
    calendar = build_dim_date(spark)
    assert list(CALENDAR_COLUMNS) == names(DIM_DATE_SCHEMA)
    assert [f.dataType for f in calendar.schema] == [f.dataType for f in DIM_DATE_SCHEMA]
    row = calendar.agg(F.count("*"), F.min("date_actual"), F.max("date_actual")).first()
    assert tuple(row) == (29_220, date(1970, 1, 1), date(2049, 12, 31))


def test_calendar_by_hand(spark):
    first = build_dim_date(spark, days=1).first()
    assert first.day_suffix == "1st"
    assert first.day_name == "Thursday"
    assert first.day_of_week == 4
    assert first.week_of_year_iso == "1970-W01-4"
    assert first.first_day_of_week == date(1969, 12, 29)
    assert (first.mmyyyy, first.mmddyyyy, first.weekend_indr) == ("011970", "01011970", False)
    last = build_dim_date(spark, start="2049-12-31", days=1).first()
    assert (last.day_suffix, last.day_name, last.epoch) == ("31st", "Friday", 2_524_521_600)
    assert (last.day_of_quarter, last.week_of_year_iso) == (92, "2049-W52-5")


def test_calendar_agrees_with_python(spark):
    for r in build_dim_date(spark).collect():
        d = r.date_actual
        year, week, weekday = d.isocalendar()
        assert r.week_of_year_iso == f"{year}-W{week:02}-{weekday}"
        assert (r.week_of_year, r.day_of_week, r.day_of_year) == (week, weekday, d.timetuple().tm_yday)
        assert r.day_name == f"{d:%A}" and r.month_name == f"{d:%B}"
        assert r.month_name_abbreviated == f"{d:%b}"
        assert r.weekend_indr == (weekday > 5)
        assert r.quarter_actual == (d.month + 2) // 3
        assert r.date_dim_id == int(f"{d:%Y%m%d}")


def drawn(rows, seed=1):
    return rows.select("id", *[draws.bits("id", seed, n).alias(n) for n in ("a", "b")])


def test_draws_do_not_depend_on_partitions(spark):
    def sample(parts):
        rows = drawn(spark.range(0, 500, 1, parts), 3)
        values = [draws.integer("a", 5, 3), draws.double("b", 0, 2), draws.wkt_point("a", "b")]
        return sorted(map(tuple, rows.select("id", *values).collect()))

    assert sample(1) == sample(7)
    assert {r[1] for r in sample(2)} == {5, 6, 7}
    assert all(0 <= r[2] <= 2 for r in sample(2))


def test_drawn_points_are_on_the_globe(spark):
    rows = drawn(spark.range(2000)).select(draws.wkt_point("a", "b").alias("p")).collect()
    points = [r.p.removeprefix("POINT (").removesuffix(")").split(" ") for r in rows]
    lon, lat = [float(p[0]) for p in points], [float(p[1]) for p in points]
    assert -180 <= min(lon) < -170 and 170 < max(lon) <= 180
    assert -90 <= min(lat) < -85 and 85 < max(lat) <= 90
    assert all(len(c.split(".")[1]) == 16 for p in points for c in p)


def test_drawn_times_are_within_bounds(spark):
    start, end = datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 0, 2)
    rows = drawn(spark.range(200)).select(draws.timestamp("a", start, end).alias("t"))
    assert rows.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert {r.t.second for r in rows.collect()} == {0, 1, 2}


@pytest.mark.parametrize("seed", [0, 1])
def test_uniform_draws_fill_their_range(spark, seed):
    rows = drawn(spark.range(20_000), seed)
    counts = rows.groupBy(draws.integer("a", 0, 10).alias("x")).count().collect()
    assert len(counts) == 10 and all(1800 < r["count"] < 2200 for r in counts)


def test_digits_of_a_draw_are_independent(spark):
    ten, three = draws.digits("a", [10, 3])
    rows = drawn(spark.range(30_000)).select(ten.alias("x"), three.alias("y"))
    pairs = rows.groupBy("x", "y").count().collect()
    assert {(r.x, r.y) for r in pairs} == {(x, y) for x in range(10) for y in range(3)}
    assert all(850 < r["count"] < 1150 for r in pairs)


def test_hashes_are_computed_once_per_draw(spark, plan_text):
    rows = drawn(spark.range(10)).select(*draws.digits("a", [2, 3, 4]), "b")
    assert plan_text(rows).count("md5") == 2


@pytest.mark.parametrize("zone", ["Pacific/Apia", "America/New_York", "Africa/Cairo"])
def test_calendar_is_the_same_in_every_time_zone(spark, zone):
    expected = build_dim_date(spark).collect()
    assert len({r.date_dim_id for r in expected}) == len(expected)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert build_dim_date(spark).collect() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

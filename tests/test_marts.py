from datetime import date, datetime

from pyspark.sql import functions as F

from cinderlake.functions.calendar import build_dim_date
from cinderlake.plans import marts

COLUMNS = (
    "incident_number long, id long, incident_date timestamp_ntz, num_alarms long,"
    " estimated_property_loss double, suppression_personnel long, ems_personnel long,"
    " other_personnel long, fire_fatalities long, civilian_fatalities long"
)


def fact(spark):
    return spark.createDataFrame(
        [
            (1, 1, datetime(2024, 1, 6), 1, 10.0, 1, 1, 1, 1, 1),
            (2, 2, datetime(2024, 1, 6), 3, 5.0, 2, None, 1, 0, 1),
            (3, 3, datetime(2024, 4, 1), 5, None, 5, 5, 5, 0, 0),
            (4, 4, datetime(2023, 1, 2), 2, 1.0, 0, 0, 0, 0, 1),
            (5, 5, datetime(2024, 1, 8, 0, 0, 7), 9, 99.0, 9, 9, 9, 9, 9),
            (6, 6, None, 9, 99.0, 9, 9, 9, 9, 9),
            (7, 7, datetime(2050, 1, 1), 9, 99.0, 9, 9, 9, 9, 9),
        ],
        COLUMNS,
    )


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_weekdays_match_at_midnight_only(spark):
    assert listed(marts.incidents_by_weekday(fact(spark))) == [("Monday", 2), ("Saturday", 2)]
    assert listed(marts.incidents_by_weekday(fact(spark), by_day=True)) == [
        ("Monday", 3),
        ("Saturday", 2),
    ]


def test_months_quarters_years(spark):
    data = fact(spark)
    assert listed(marts.average_alarms_by_month(data)) == [("January", 2.0), ("April", 5.0)]
    assert listed(marts.property_loss_by_quarter(data)) == [("First", 16.0), ("Second", None)]
    assert listed(marts.response_by_year(data)) == [(2023, 1, 0.0), (2024, 3, 9.0)]


def test_fatalities_per_hundred_incidents(spark):
    rates = sorted(listed(marts.fatality_rate_by_weekend(fact(spark))))
    assert rates == [(False, 50.0), (True, 150.0)]


def test_top_days(spark):
    assert listed(marts.top_days_by_alarms(fact(spark), days=2)) == [
        (date(2024, 4, 1), 5.0),
        (date(2023, 1, 2), 2.0),
    ]


def test_a_calendar_of_ones_own(spark):
    short = build_dim_date(spark, start="2024-01-01", days=30)
    assert listed(marts.incidents_by_weekday(fact(spark), calendar=short)) == [("Saturday", 2)]


def test_calendar_with_counts(spark):
    days = marts.calendar_with_counts(fact(spark))
    assert days.count() == 29_220
    busy = days.where("incident_count > 0").select("date_actual", "incident_count")
    assert listed(busy) == [(date(2023, 1, 2), 1), (date(2024, 1, 6), 2), (date(2024, 4, 1), 1)]


def test_latest_rows(spark):
    data = fact(spark)
    assert [r.id for r in marts.latest_rows(data, rows=3).collect()] == [7, 6, 5]
    assert [r.id for r in marts.latest_rows(data, rows=10).collect()] == [7, 6, 5, 4, 3, 2, 1]
    many = spark.range(1000).select(
        F.when(F.col("id") > 3, F.col("id") % 5).alias("incident_number"), "id"
    )
    assert listed(marts.latest_rows(many)) == [(4, 999 - 5 * n) for n in range(10)]
    few = many.where("id < 9")
    assert [r.id for r in marts.latest_rows(few, rows=7).collect()] == [4, 8, 7, 6, 5, 3, 2]
    assert marts.row_count(data).first()[0] == 7


def test_plans_scan_once_and_broadcast_the_calendar(spark, plan_text, tmp_path):
    path = str(tmp_path / "fact")
    fact(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_text(marts.average_alarms_by_month(stored))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<incident_date:timestamp_ntz,num_alarms:bigint>" in plan
    assert "IsNotNull(incident_date)" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # The fact is reduced by a partial aggregate before the first shuffle.
    assert plan.index("partial_avg") < plan.index("BroadcastHashJoin")
    assert "TakeOrderedAndProject" in plan_text(marts.top_days_by_alarms(stored))


def test_calendar_with_counts_comes_in_order_of_days(spark):
    fact = spark.sql("SELECT DATE'1970-01-03' AS day UNION ALL SELECT DATE'2001-05-01'")
    days = [r.date_actual for r in marts.calendar_with_counts(fact, date="day").collect()]
    assert len(days) == 29_220 and days == sorted(days)

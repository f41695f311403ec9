"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar runs from this day for this many days (to 2049-12-31).
CALENDAR_START = "1970-01-01"
CALENDAR_DAYS = 29_220

_DAYS = "'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'"
_MONTHS = (
    "'January', 'February', 'March', 'April', 'May', 'June',"
    " 'July', 'August', 'September', 'October', 'November', 'December'"
)

# Output column -> expression over the date column ``d``. Weeks start on Monday,
# and weekday() counts Monday as 0. Nothing here goes through a timestamp, so the
# session's time zone does not matter.
CALENDAR_COLUMNS = {
    "date_dim_id": "year(d) * 10000 + month(d) * 100 + day(d)",
    "date_actual": "d",
    "epoch": "cast(unix_date(d) AS bigint) * 86400",
    "day_suffix": """concat(day(d), CASE
        WHEN day(d) BETWEEN 11 AND 13 THEN 'th'
        WHEN day(d) % 10 = 1 THEN 'st'
        WHEN day(d) % 10 = 2 THEN 'nd'
        WHEN day(d) % 10 = 3 THEN 'rd'
        ELSE 'th' END)""",
    "day_name": f"element_at(array({_DAYS}), weekday(d) + 1)",
    "day_of_week": "weekday(d) + 1",
    "day_of_month": "day(d)",
    "day_of_quarter": "datediff(d, trunc(d, 'quarter')) + 1",
    "day_of_year": "dayofyear(d)",
    "week_of_month": "cast((day(d) - 1) div 7 + 1 AS int)",
    "week_of_year": "weekofyear(d)",
    "week_of_year_iso": """concat(extract(YEAROFWEEK FROM d), '-W',
        lpad(weekofyear(d), 2, '0'), '-', weekday(d) + 1)""",
    "month_actual": "month(d)",
    "month_name": f"element_at(array({_MONTHS}), month(d))",
    "month_name_abbreviated": f"left(element_at(array({_MONTHS}), month(d)), 3)",
    "quarter_actual": "quarter(d)",
    "quarter_name": "element_at(array('First', 'Second', 'Third', 'Fourth'), quarter(d))",
    "year_actual": "year(d)",
    "first_day_of_week": "trunc(d, 'week')",
    "last_day_of_week": "date_add(trunc(d, 'week'), 6)",
    "first_day_of_month": "trunc(d, 'month')",
    "last_day_of_month": "last_day(d)",
    "first_day_of_quarter": "trunc(d, 'quarter')",
    "last_day_of_quarter": "date_sub(add_months(trunc(d, 'quarter'), 3), 1)",
    "first_day_of_year": "trunc(d, 'year')",
    "last_day_of_year": "make_date(year(d), 12, 31)",
    "mmyyyy": "concat(lpad(month(d), 2, '0'), lpad(year(d), 4, '0'))",
    "mmddyyyy": "concat(lpad(month(d), 2, '0'), lpad(day(d), 2, '0'), lpad(year(d), 4, '0'))",
    "weekend_indr": "weekday(d) >= 5",
}


def build_dim_date(
    spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS
) -> DataFrame:
    """One row per day from ``start``; columns that are not used are never computed.

    A calendar has ``days`` rows whatever the fact holds, so it is kept in few
    partitions and can be broadcast.
    """
    series = spark.range(0, days, 1, 1 + days // 100_000)
    dated = series.select(F.expr(f"date_add(DATE'{start}', cast(id AS int)) AS d"))
    return dated.select(*[F.expr(sql).alias(name) for name, sql in CALENDAR_COLUMNS.items()])

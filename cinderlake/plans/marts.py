"""Analytical queries over the fact and the calendar.

All of them join the fact to the calendar on the incident date and aggregate by
calendar attributes. The calendar is broadcast, so the fact is scanned once, pruned to
the columns in use and reduced in each task before anything is shuffled.

A row matches the calendar when its timestamp equals a day, that is, at midnight only.
``by_day=True`` matches on the day of the timestamp instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.functions.calendar import build_dim_date
from cinderlake.operators.joins import fits_broadcast

DATE = "incident_date"


def join_calendar(
    fact: DataFrame,
    attributes: Sequence[str],
    calendar: DataFrame | None = None,
    date: str = DATE,
    by_day: bool = False,
) -> DataFrame:
    """Inner join of the fact with the calendar, adding some of its attributes.

    The standard calendar has a fixed number of rows and is broadcast; one that is
    passed in is broadcast if it is small enough.
    """
    side = build_dim_date(fact.sparkSession) if calendar is None else calendar
    side = side.select(F.col("date_actual").alias("_day"), *attributes)
    if calendar is None or fits_broadcast(side):
        side = F.broadcast(side)
    moment = F.to_date(date) if by_day else F.col(date)
    return fact.join(side, moment == F.col("_day"))


def incidents_by_weekday(fact: DataFrame, **join) -> DataFrame:
    """Number of incidents by day of the week, Monday first."""
    days = join_calendar(fact, ["day_name", "day_of_week"], **join)
    counts = days.groupBy("day_name", "day_of_week").agg(F.count("*").alias("incident_count"))
    return counts.orderBy("day_of_week").select("day_name", "incident_count")


def average_alarms_by_month(
    fact: DataFrame, alarms: str | Column = "num_alarms", **join
) -> DataFrame:
    """Average number of alarms by month of the year, over all years."""
    days = join_calendar(fact, ["month_name", "month_actual"], **join)
    means = days.groupBy("month_name", "month_actual").agg(F.avg(alarms).alias("avg_alarms"))
    return means.orderBy("month_actual").select("month_name", "avg_alarms")


def property_loss_by_quarter(
    fact: DataFrame, loss: str | Column = "estimated_property_loss", **join
) -> DataFrame:
    """Total property loss by quarter of the year, over all years."""
    days = join_calendar(fact, ["quarter_name", "quarter_actual"], **join)
    sums = days.groupBy("quarter_name", "quarter_actual").agg(
        F.sum(loss).alias("total_property_loss")
    )
    return sums.orderBy("quarter_actual").select("quarter_name", "total_property_loss")


# The personnel counts that add up to the response to an incident.
PERSONNEL = ("suppression_personnel", "ems_personnel", "other_personnel")


def response_by_year(
    fact: DataFrame, personnel: Sequence[str] = PERSONNEL, **join
) -> DataFrame:
    """Incidents and average personnel by year; NULL in one count leaves the row out of the mean."""
    total = F.col(personnel[0])
    for column in personnel[1:]:
        total = total + F.col(column)
    return (
        join_calendar(fact, ["year_actual"], **join)
        .groupBy("year_actual")
        .agg(F.count("*").alias("incident_count"), F.avg(total).alias("avg_personnel_response"))
        .orderBy("year_actual")
    )


# The two counts of people killed.
FATALITIES = ("fire_fatalities", "civilian_fatalities")


def fatality_rate_by_weekend(
    fact: DataFrame, fatalities: Sequence[str] = FATALITIES, **join
) -> DataFrame:
    """Fatalities per 100 incidents, on weekends and on weekdays."""
    killed = F.sum(fatalities[0])
    for column in fatalities[1:]:
        killed = killed + F.sum(column)
    return (
        join_calendar(fact, ["weekend_indr"], **join)
        .groupBy("weekend_indr")
        .agg((killed / F.count("*") * 100).alias("percentage_fatalities"))
    )


def top_days_by_alarms(
    fact: DataFrame, days: int = 5, alarms: str | Column = "num_alarms", **join
) -> DataFrame:
    """The days with the highest average number of alarms, the earlier one among equals."""
    return (
        join_calendar(fact, [], **join)
        .groupBy(F.col("_day").alias("date_actual"))
        .agg(F.avg(alarms).alias("avg_alarms"))
        .orderBy(F.desc("avg_alarms"), "date_actual")
        .limit(days)
    )


def calendar_with_counts(
    fact: DataFrame, calendar: DataFrame | None = None, date: str = DATE
) -> DataFrame:
    """Every day of the calendar, in order, with the number of incidents on it."""
    side = build_dim_date(fact.sparkSession) if calendar is None else calendar
    day = F.to_date(date)
    counts = (
        fact.where(F.col(date) == day)
        .groupBy(day.alias("_day"))
        .agg(F.count("*").alias("incident_count"))
    )
    return (
        side.join(counts, F.col("date_actual") == F.col("_day"), "left")
        .select(*side.columns, F.coalesce("incident_count", F.lit(0)).alias("incident_count"))
        .orderBy("date_dim_id")
    )


def latest_rows(
    fact: DataFrame, by: Sequence[str] = ("incident_number", "id"), rows: int = 10
) -> DataFrame:
    """The rows with the highest values, for a look at what was loaded last.

    The first column alone tells below which value no row can be among them. Reading it
    is cheap, and the filter it gives lets the scan of all columns skip row groups.
    """
    first = F.col(by[0])
    floor = fact.select(first).orderBy(first.desc()).limit(rows).agg(
        F.count("*").alias("n"), F.count(first).alias("known"), F.min(first).alias("value")
    ).first()
    if floor["n"] == rows and floor["known"] == rows:
        fact = fact.where(first >= F.lit(floor["value"]))
    return fact.orderBy(*[F.desc(c) for c in by]).limit(rows)


def row_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("row_count"))


@dataclass(frozen=True)
class Measures:
    """The columns that the marts add up. A list may have any number of columns but none."""

    alarms: str | Column = "num_alarms"
    loss: str | Column = "estimated_property_loss"
    personnel: Sequence[str] = PERSONNEL
    fatalities: Sequence[str] = FATALITIES

    def response(self) -> Column:
        return reduce(add, [F.col(c) for c in self.personnel])

    def killed(self) -> Column:
        return reduce(add, [F.sum(c) for c in self.fatalities])


# The marts that group by an attribute of the calendar: what names a row, and what orders rows.
GROUPED_MARTS = {
    "incidents_by_weekday": ("day_name", "day_of_week"),
    "average_alarms_by_month": ("month_name", "month_actual"),
    "property_loss_by_quarter": ("quarter_name", "quarter_actual"),
    "response_by_year": ("year_actual", "year_actual"),
    "fatality_rate_by_weekend": ("weekend_indr", "weekend_indr"),
}
MART_ATTRIBUTES = tuple(dict.fromkeys(c for pair in GROUPED_MARTS.values() for c in pair))


def stacked(grouped: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Groups by the attributes of one mart each, as rows ``(mart, place, label, ...)``.

    An attribute of another mart is NULL. ``values`` are the numbers of every group; a mart keeps its own.
    """
    mart = F.coalesce(
        *[F.when(F.col(order).isNotNull(), name) for name, (_, order) in GROUPED_MARTS.items()]
    )
    label = F.coalesce(*[F.col(name).cast("string") for name, _ in GROUPED_MARTS.values()])
    place = F.coalesce(*[F.col(order).cast("int") for _, order in GROUPED_MARTS.values()])
    of = {
        "incident_count": ("incidents_by_weekday", "response_by_year"),
        "avg_alarms": ("average_alarms_by_month",),
        "total_property_loss": ("property_loss_by_quarter",),
        "avg_personnel_response": ("response_by_year",),
        "percentage_fatalities": ("fatality_rate_by_weekend",),
    }
    return grouped.select(
        mart.alias("mart"), place.alias("place"), label.alias("label"),
        *[F.when(mart.isin(*marts), values[n]).alias(n) for n, marts in of.items()],
    )


def marts_in_one_scan(fact: DataFrame, measures: Measures | None = None, **join) -> DataFrame:
    """The five marts by calendar attribute as one frame, from one scan and one shuffle of the fact.

    ``(mart, place, label)`` name a row: ``place`` orders the rows of a mart, ``label`` is its attribute as
    text. A number that a mart does not have is NULL. Rows are grouped by grouping sets, so each
    task shuffles no more than one row per group of every mart.
    """
    measures = measures or Measures()
    days = join_calendar(fact, MART_ATTRIBUTES, **join)
    sets = [list(dict.fromkeys(pair)) for pair in GROUPED_MARTS.values()]
    grouped = days.groupingSets(sets, *MART_ATTRIBUTES).agg(
        F.count("*").alias("_incidents"),
        F.avg(measures.alarms).alias("_alarms"),
        F.sum(measures.loss).alias("_loss"),
        F.avg(measures.response()).alias("_response"),
        measures.killed().alias("_killed"),
    )
    return stacked(
        grouped,
        {
            "incident_count": F.col("_incidents"),
            "avg_alarms": F.col("_alarms"),
            "total_property_loss": F.col("_loss"),
            "avg_personnel_response": F.col("_response"),
            "percentage_fatalities": F.col("_killed") / F.col("_incidents") * 100,
        },
    )

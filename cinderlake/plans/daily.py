"""Marts that are kept up to date: each load adds sums by day, and marts are put together from these.

Counts and sums of disjoint sets of facts add up, and every mart follows from them: a mean is a sum over a
count. A load's facts are read once, when it is added; a mart reads no facts at all, only
as many rows as there are days and loads. Facts never change once they are in, so neither do the sums
of a load; adding a load again replaces its sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.plans.marts import (
    DATE,
    GROUPED_MARTS,
    MART_ATTRIBUTES,
    Measures,
    join_calendar,
    stacked,
)
from cinderlake.sources.warehouse import Warehouse

TABLE = "mart_by_day"
_FACT = "fact_fire_department_injuries"
_DAY = "day"


def sums_by_day(
    fact: DataFrame, measures: Measures | None = None, date: str = DATE, by_day: bool = False
) -> DataFrame:
    """Counts and sums of each day: ``day``, ``incidents``, and per measure a sum and how many values it has.

    Rows that match no day, those not at midnight unless ``by_day``, are in no mart and not in the sums.
    """
    measures = measures or Measures()
    day = F.to_date(date)
    known = fact.where(day.isNotNull() if by_day else F.col(date) == day)
    added: dict[str, str | Column] = {
        "alarms": measures.alarms, "loss": measures.loss, "response": measures.response(),
        **{f"killed{n}": F.col(c) for n, c in enumerate(measures.fatalities)},
    }
    sums = [F.sum(c).alias(f"{n}_sum") for n, c in added.items()]
    counts = [F.count(c).alias(f"{n}_count") for n, c in added.items()]
    return known.groupBy(day.alias(_DAY)).agg(F.count("*").alias("incidents"), *sums, *counts)


def merged(sums: DataFrame) -> DataFrame:
    """Sums of several loads as one row per day."""
    numbers = [c for c in sums.columns if c != _DAY]
    return sums.groupBy(_DAY).agg(*[F.sum(c).alias(c) for c in numbers])


def grouped_marts(sums: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """What ``marts.marts_in_one_scan`` gives, from sums by day of any number of loads."""
    days = join_calendar(sums, MART_ATTRIBUTES, calendar, _DAY)
    sets = [list(dict.fromkeys(pair)) for pair in GROUPED_MARTS.values()]
    numbers = [c for c in sums.columns if c != _DAY]
    grouped = days.groupingSets(sets, *MART_ATTRIBUTES).agg(
        *[F.sum(c).alias(f"_{c}") for c in numbers]
    )
    killed = F.lit(0)
    for c in numbers:
        if c.startswith("killed") and c.endswith("_sum"):
            killed = killed + F.col(f"_{c}")
    return stacked(
        grouped,
        {
            "incident_count": F.col("_incidents"),
            "avg_alarms": _mean("_alarms"),
            "total_property_loss": F.col("_loss_sum"),
            "avg_personnel_response": _mean("_response"),
            "percentage_fatalities": killed / F.col("_incidents") * 100,
        },
    )


def top_days_by_alarms(sums: DataFrame, days: int = 5) -> DataFrame:
    """What ``marts.top_days_by_alarms`` gives, from sums by day of any number of loads."""
    means = merged(sums).select(F.col(_DAY).alias("date_actual"), _mean("alarms").alias("avg_alarms"))
    known = join_calendar(means, [], None, "date_actual").select("date_actual", "avg_alarms")
    return known.orderBy(F.desc("avg_alarms"), "date_actual").limit(days)


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_count"))


def add_load(warehouse: Warehouse, load_id: str) -> int:
    """Add the sums of a load's facts to the warehouse; returns the number of days they have.

    Reads the folder of this load alone. A load that brought no fact adds nothing.
    """
    spark = warehouse.spark
    gained = warehouse.read_load(_FACT, load_id)
    if gained is None:
        return 0
    folder = warehouse.folder(TABLE, load_id)
    # No more rows than the calendar has days.
    sums_by_day(gained).coalesce(1).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder).count()


def sums_of_loads(warehouse: Warehouse) -> DataFrame:
    """The sums of all loads that were added; no rows before the first."""
    empty = sums_by_day(warehouse.read(_FACT).limit(0))
    if not warehouse.has(TABLE):
        return empty
    return _read(warehouse.spark, warehouse.path(TABLE), empty).select(*empty.columns)


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)

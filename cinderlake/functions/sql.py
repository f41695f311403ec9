"""Text cleaning, acronyms and the calendar as SQL functions.

They are made of SQL text, which the optimizer puts in place of the call, so a query
with them has the plan that the same expressions written out would have.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cinderlake.functions.calendar import CALENDAR_COLUMNS, CALENDAR_DAYS, CALENDAR_START
from cinderlake.functions.text import WHITESPACE
from cinderlake.schemas import DIM_DATE_SCHEMA

CLEAN, ACRONYM, CALENDAR = "clean_text", "city_acronym", "calendar"


def register_functions(spark: SparkSession) -> None:
    """Make ``clean_text(value)``, ``city_acronym(value)`` and ``calendar(first, days)`` known to SQL.

    ``calendar`` is a table function with the columns of the calendar table; without arguments
    it gives the whole standard calendar. The functions last as long as the session.
    """
    space = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {CLEAN}(value STRING) RETURNS STRING "
        f"COMMENT 'Upper case without white space at either end' RETURN btrim(upper(value), '{space}')"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {ACRONYM}(value STRING) RETURNS STRING "
        "COMMENT 'First letters of the words; short words whole' "
        "RETURN array_join(transform(split(value, ' ', -1), "
        "w -> CASE WHEN length(w) > 2 THEN substring(w, 1, 1) ELSE w END), '')"
    )
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DIM_DATE_SCHEMA.fields)
    values = ", ".join(
        f"CAST({CALENDAR_COLUMNS[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in DIM_DATE_SCHEMA.fields
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {CALENDAR}("
        f"first DATE DEFAULT DATE'{CALENDAR_START}', days INT DEFAULT {CALENDAR_DAYS}) "
        f"RETURNS TABLE({columns}) COMMENT 'A row per day' "
        f"RETURN SELECT {values} FROM (SELECT date_add(first, n) AS d "
        "FROM (SELECT explode(sequence(0, days - 1)) AS n WHERE days > 0))"
    )

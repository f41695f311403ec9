"""Column-level operators: naming, binding, positional load, filling, casting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.functions.text import clean_str


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strict_cast(value: str, kind: T.DataType, what: str) -> str:
    """SQL for a cast that fails the job on a value that does not fit, whatever the session says.

    ``value`` is SQL too; ``what`` names it in the error.
    """
    name = kind.simpleString()
    text = "'" + what.replace("\\", "\\\\").replace("'", "\\'") + "'"
    failure = f"raise_error(concat({text}, ' does not fit {name}: ', CAST({value} AS string)))"
    return f"CASE WHEN {value} IS NOT NULL THEN coalesce(try_cast({value} AS {name}), {failure}) END"


def _cast(df: DataFrame, column: str, field: T.StructField) -> str:
    quoted = _quoted(column)
    if df.schema[column].dataType != field.dataType:
        quoted = strict_cast(quoted, field.dataType, f"column {column}")
    return f"{quoted} AS {_quoted(field.name)}"


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn spaces into underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if a column is missing; more columns than asked for are fine."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make the job fail on a NULL in one of these columns; no pass of its own is needed."""
    checked = {}
    for name in columns:
        column = F.col(_quoted(name))
        failure = F.raise_error(F.lit(f"NULL in column {name}")).cast(df.schema[name].dataType)
        checked[name] = F.when(column.isNotNull(), column).otherwise(failure)
    return df.withColumns(checked)


def bind_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise unless ``df`` has exactly these columns; return them in this order."""
    require_columns(df, columns)
    unexpected = sorted(set(df.columns) - set(columns))
    if unexpected:
        raise ValueError(f"unexpected columns: {unexpected}")
    if len(df.columns) != len(set(df.columns)):
        raise ValueError(f"repeated column names: {df.columns}")
    return df.select(*[_quoted(c) for c in columns])


def load_by_position(df: DataFrame, table: T.StructType) -> DataFrame:
    """Give the n-th column the name and type of the table's n-th column."""
    if len(df.columns) != len(table.fields):
        raise ValueError(f"{len(df.columns)} columns do not fit a table of {len(table.fields)}")
    return df.selectExpr(*[_cast(df, c, f) for c, f in zip(df.columns, table.fields)])


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast columns by name; a value that does not fit its type fails the job."""
    return df.selectExpr(*[_cast(df, f.name, f) for f in schema.fields])


def map_strings(df: DataFrame, function: Callable[[Column], Column] = clean_str) -> DataFrame:
    """Apply a string function to every string column; other columns are unchanged."""
    return df.select(
        *[
            function(F.col(_quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(_quoted(f.name))
            for f in df.schema.fields
        ]
    )


def fill_nulls(df: DataFrame, columns: Sequence[str], value: int | float = 0) -> DataFrame:
    """Put ``value`` where one of the numeric ``columns`` is NULL."""
    return df.na.fill(value, subset=list(columns))

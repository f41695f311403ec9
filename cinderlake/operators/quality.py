"""Collisions, repeats, constraints and maxima."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.workspace import empty_frame, materialize


def _field_values(
    df: DataFrame, fields: Sequence[str], *carry: str
) -> tuple[DataFrame, list[str]]:
    """One row per row and field, all in a single scan, and the names of the value columns.

    ``field`` is the field's place in the list, counted from 1. There is a value column for each
    type in use; a row fills the one of its field and leaves the others NULL, so values
    are compared as what they are.
    """
    types = [df.schema[f].dataType for f in fields]
    kinds = list(dict.fromkeys(types))
    values = [f"value{n}" for n in range(len(kinds))]

    def typed(field: str, kind: T.DataType) -> list[Column]:
        return [
            (F.col(field) if kind == other else F.lit(None).cast(other)).alias(value)
            for other, value in zip(kinds, values)
        ]

    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("field"), *typed(f, t))
            for n, (f, t) in enumerate(zip(fields, types), 1)
        ]
    )
    exploded = df.select(*carry, F.explode(pairs).alias("_pair"))
    return exploded.select(*carry, "_pair.field", *[f"_pair.{v}" for v in values]), values


# Logical plan nodes that give each row of a file at most once.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "View"}
_FILE_KEY = ("_file", "_index")


def _with_file_key(df: DataFrame) -> DataFrame | None:
    """``df`` with two numbers that name the row of the Parquet file it comes from.

    None if ``df`` is not a filtered, projected scan of Parquet files, or if two of its files have the same
    hash, which a scan without columns checks.
    """
    plan = df._jdf.queryExecution().analyzed()
    while True:
        if plan.getClass().getSimpleName() not in _ROW_BY_ROW or not plan.deterministic():
            return None
        if plan.children().isEmpty():
            break
        plan = plan.children().head()
    file = F.xxhash64("_metadata.file_path")
    try:
        keyed = df.select("*", file.alias(_FILE_KEY[0]), F.col("_metadata.row_index").alias(_FILE_KEY[1]))
        files = df.select(F.col("_metadata.file_path").alias("path"), file.alias("file")).distinct()
    except AnalysisException:
        return None
    paths, hashes = files.agg(F.count("path"), F.count_distinct("file")).first()
    return keyed if paths == hashes else None


def drop_colliding_rows(
    df: DataFrame, fields: Sequence[str], row_key: str | None = None
) -> DataFrame:
    """Drop every row that shares its value of any one field with another row.

    All members of a collision go, not all but one; fields are judged one by one and
    over the whole frame. NULL collides with nothing.

    Each field that is unique for a row gives the row a vote, and the rows with a vote
    from every field stay. Votes come from aggregates, which shrink a very common value
    to one row per task before the shuffle, and the full rows are shuffled once, on
    ``row_key``. That column must be unique and come out the same when the frame is
    read again. Without one, rows of Parquet files are known by file and position; any other
    frame is numbered and written first.
    """
    keys: tuple[str, ...] = (row_key,) if row_key else _FILE_KEY
    frame = df if row_key else _with_file_key(df)
    if frame is None:
        keys = ("_row",)
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        frame = materialize(numbered, "numbered")
    values, columns = _field_values(frame, fields, *keys)
    lone = (
        values.where(reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in columns]))
        .groupBy("field", *columns)
        .agg(F.count("*").alias("_n"), *[F.max(k).alias(k) for k in keys])
        .where("_n = 1")
        .select(*keys, F.lit(1).alias("_votes"))
    )
    blanks = sum((F.col(f).isNull().cast("int") for f in fields), F.lit(0))
    empty = frame.select(*keys, blanks.alias("_votes")).where("_votes > 0")
    survivors = (
        lone.unionByName(empty)
        .groupBy(*keys)
        .agg(F.sum("_votes").alias("_votes"))
        .where(F.col("_votes") == len(fields))
        .select(*keys)
    )
    return frame.join(survivors, list(keys), "left_semi").select(*df.columns)


def find_repeated_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(field, value, count)`` of every value that occurs more than once in a field.

    Values are compared in their own types and reported as text. Most frequent first within
    each field. NULLs are counted too.
    """
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("field"))
    values, columns = _field_values(df, fields)
    text = F.coalesce(*[F.col(v).cast("string") for v in columns])
    return (
        values.groupBy("field", *columns)
        .agg(F.count("*").alias("count"))
        .where("count > 1")
        .select(name.alias("field"), text.alias("value"), "count")
        .orderBy("field", F.desc("count"), "value")
    )


def repeated_by_field(
    df: DataFrame, fields: Sequence[str]
) -> tuple[DataFrame, dict[str, str]]:
    """The values that occur more than once, as a written table, in their own types.

    ``field`` is a field's place in the list, from 1; the second result says which column has the values of
    which field.
    """
    values, columns = _field_values(df, fields)
    counted = values.groupBy("field", *columns).agg(F.count("*").alias("count"))
    kinds = [df.schema[f].dataType for f in fields]
    places = {kind: n for n, kind in enumerate(dict.fromkeys(kinds))}
    value_of = {f: columns[places[k]] for f, k in zip(fields, kinds)}
    return materialize(counted.where("count > 1"), "repeats"), value_of


def assert_no_repeats(report: DataFrame) -> None:
    """Raise if a report of repeated values has any row."""
    sample = report.limit(5).collect()
    if sample:
        raise ValueError(f"repeated values in a field that must be unique, e.g. {sample}")


def max_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row with the maximum of each numeric field, 0 where there is none; one pass."""
    other = [f for f in fields if not isinstance(df.schema[f].dataType, T.NumericType)]
    if other:
        raise ValueError(f"not numeric, so 0 is no value of theirs: {other}")
    return df.agg(*[F.coalesce(F.max(f), F.lit(0)).alias(f) for f in fields])


def constraint_report(
    df: DataFrame, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """``(constraint, columns, violations)`` for uniqueness and NOT NULL.

    A violation of uniqueness is a key that occurs more than once, NULL keys aside; a
    violation of NOT NULL is a row.
    """
    parts = []
    for keys in unique:
        repeated = (
            df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
        )
        parts.append(
            repeated.agg(F.count("*").alias("violations")).select(
                F.lit("unique").alias("constraint"),
                F.lit(",".join(keys)).alias("columns"),
                "violations",
            )
        )
    if not_null:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in not_null])
        parts.append(
            counts.select(F.explode(pairs).alias("_pair")).select(
                F.lit("not_null").alias("constraint"),
                F.col("_pair.c").alias("columns"),
                F.col("_pair.n").alias("violations"),
            )
        )
    kinds = T.StructType().add("constraint", "string").add("columns", "string")
    report = empty_frame(df.sparkSession, kinds.add("violations", "long"))
    for part in parts:
        report = report.unionByName(part)
    return report

"""Reading snapshots that may hold bad lines: the good rows, and a table of what was rejected."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.operators.columns import require_columns
from cinderlake.schemas import INCIDENT_SCHEMA, REJECT_SCHEMA, names
from cinderlake.sources.snapshots import CSV_OPTIONS, NA_TOKENS, known_value
from cinderlake.workspace import counted, literal_path, new_folder

_LINE, _FILE, _ERRORS = "_rejected_line", "_file", "_errors"
MALFORMED, MISSING = "malformed line", "missing value"


class TooManyRejects(ValueError):
    """A snapshot has more bad lines than allowed."""


@dataclass(frozen=True)
class Checked:
    """The rows of a snapshot that fit, why others do not (a row per fault), and how many they are."""

    rows: DataFrame
    rejects: DataFrame
    rejected_lines: int


def read_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = INCIDENT_SCHEMA,
    most_rejects: int | None = None,
    required: Sequence[str] = (),
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = False,
) -> Checked:
    """Read a CSV file or directory, or a list of files, as ``read_snapshot`` does, but go on at bad lines.

    A line is rejected if it has more or fewer values than the header, if a value does not fit its type, or
    if one of the ``required`` columns has no value. The table of rejects names the file, the line as text, the
    column, the value and the reason, with a row for every fault of a line; a line that does not split
    into columns has one fault and no column. More than ``most_rejects`` bad lines raise
    ``TooManyRejects``; the count is known before anything is loaded. Missing, unexpected or
    repeated columns, and files with different headers, are errors as ever.

    The files are parsed once. What the parse gives is written, good and bad lines in one table, and both
    results read it; the rejects' scan skips what has no faults by the statistics of the file.
    """
    def lines():
        return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)

    given = [literal_path(p) for p in ([path] if isinstance(path, str) else path)]
    columns = lines().csv(given[:1]).columns
    header = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    raw = (
        lines()
        .schema(header)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        .csv(given)
    )
    plain = [c.lower().replace(" ", "_") for c in columns]
    if len(set(plain)) != len(plain):
        raise ValueError(f"repeated column names: {plain}")
    require_columns(spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in plain])), names(schema))
    unexpected = sorted(set(plain) - set(names(schema)))
    if unexpected:
        raise ValueError(f"unexpected columns: {unexpected}")
    require_columns(raw.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(columns, plain)]), required)
    named = raw.selectExpr(
        *[f"`{c}` AS `{p}`" for c, p in zip(columns, plain)], f"`{_LINE}`",
        f"_metadata.file_path AS `{_FILE}`",
    )
    typed = named.selectExpr(
        *[f"{_value(f, na_tokens)} AS `{f.name}`" for f in schema.fields],
        f"{_faults(schema, required, na_tokens)} AS `{_ERRORS}`",
        f"coalesce(`{_LINE}`, to_csv(struct({', '.join(f'`{p}`' for p in plain)}), map('escape', '\"'))) AS `{_LINE}`",
        f"`{_FILE}`",
    )
    bad = F.size(_ERRORS) > 0
    whole = typed.withColumns(
        {n: F.when(bad, F.col(n)) for n in (_LINE, _FILE)} | {"_bad": bad}
    )
    observed, seen = counted(whole.select("*"), rejected=F.count_if("_bad"))
    folder = new_folder(spark, "checked")
    observed.write.parquet(folder)
    rejected = seen.get["rejected"]
    written = spark.read.schema(whole.schema).parquet(folder)
    faults = written.where("_bad").select(
        F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), F.explode(_ERRORS).alias("fault")
    )
    rejects = faults.select("file", "line", "fault.*").select(*names(REJECT_SCHEMA))
    if most_rejects is not None and rejected > most_rejects:
        sample = [tuple(r) for r in rejects.select("column_name", "value", "reason").limit(5).collect()]
        raise TooManyRejects(
            f"{rejected} bad lines where {most_rejects} are allowed, e.g. {sample}"
        )
    return Checked(written.where("NOT _bad").select(*names(schema)), rejects, rejected)


def _value(field: T.StructField, na_tokens: Sequence[str]) -> str:
    return (
        f"CASE WHEN {known_value(field.name, na_tokens)} "
        f"THEN try_cast(`{field.name}` AS {field.dataType.simpleString()}) END"
    )


def _faults(schema: T.StructType, required: Sequence[str], na_tokens: Sequence[str]) -> str:
    """An array of what is wrong with a line: column, value, reason."""

    def fault(column: str, value: str, reason: str) -> str:
        return (
            f"named_struct('column_name', CAST({column} AS string), 'value', CAST({value} AS string), "
            f"'reason', '{reason}')"
        )

    found = []
    for field in schema.fields:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        known = known_value(field.name, na_tokens)
        if field.name in required:
            there = f"({name} IS NOT NULL AND {known})"
            found.append(f"CASE WHEN NOT {there} THEN {fault(repr(field.name), name, MISSING)} END")
        if not isinstance(field.dataType, T.StringType):
            found.append(
                f"CASE WHEN {name} IS NOT NULL AND {known} AND try_cast({name} AS {kind}) IS NULL "
                f"THEN {fault(repr(field.name), name, 'not a ' + kind)} END"
            )
    torn = f"array({fault('NULL', 'NULL', MALFORMED)})"
    if not found:
        return f"CASE WHEN `{_LINE}` IS NOT NULL THEN {torn} ELSE slice({torn}, 1, 0) END"
    return (
        f"CASE WHEN `{_LINE}` IS NOT NULL THEN {torn} "
        f"ELSE filter(array({', '.join(found)}), f -> f IS NOT NULL) END"
    )

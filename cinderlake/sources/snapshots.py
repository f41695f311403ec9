"""Cumulative CSV snapshots: listing, picking the latest, reading, writing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.operators.columns import bind_columns, normalize_names, strict_cast
from cinderlake.schemas import INCIDENT_SCHEMA, names
from cinderlake.session import small_methods
from cinderlake.workspace import empty_frame, hadoop_path, literal_path

# The texts that count as a missing value, as in pandas' read_csv.
# The empty text is always missing.
NA_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# With these options a frame survives writing and reading unchanged, but for empty
# texts, which come back as NULL.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# What a finished write leaves in a directory of part files.
MARKER = "_SUCCESS"


def _is_csv(name: str) -> bool:
    return name.lower().endswith(".csv")


def find_snapshots(
    spark: SparkSession, root: str, unmarked: bool = False
) -> list[tuple[str, int]]:
    """``(name, modified)``: every CSV file or directory of part files below ``root``.

    The file system lists the folders; no file is opened. A snapshot is named by its path below
    ``root``, an absolute path or a URI, and its time is in milliseconds. A directory whose
    name ends in .csv (in any case) is a snapshot once it has the marker of a finished write, whose time
    it takes. ``unmarked`` also takes directories without one, as other tools write them,
    at the time of their newest file. Names that begin with ``_`` or ``.`` are passed over.
    """
    if not root.startswith("/") and "://" not in root and not root.startswith("file:/"):
        raise ValueError(f"the folder of snapshots must be an absolute path or a URI, not {root!r}")
    system, top = hadoop_path(spark, root)
    found, waiting = [], [("", top)]
    while waiting:
        above, folder = waiting.pop()
        for status in system.listStatus(folder):
            name, path = status.getPath().getName(), status.getPath()
            if name.startswith(("_", ".")):
                continue
            if status.isFile():
                if _is_csv(name):
                    found.append((above + name, status.getModificationTime()))
            elif not _is_csv(name):
                waiting.append((f"{above}{name}/", path))
            else:
                inside = list(system.listStatus(path))
                times = [s.getModificationTime() for s in inside if s.getPath().getName() == MARKER]
                if unmarked and not times:
                    times = [s.getModificationTime() for s in inside if s.isFile()]
                if times:
                    found.append((above + name, max(times)))
    return found


def list_snapshots(spark: SparkSession, root: str, unmarked: bool = False) -> DataFrame:
    """``find_snapshots`` as a frame ``(snapshot, modified)``."""
    rows = find_snapshots(spark, root, unmarked)
    frame = spark.createDataFrame(rows, "snapshot string, millis long")
    return frame.select("snapshot", F.timestamp_millis("millis").alias("modified"))


def latest_snapshot(spark: SparkSession, root: str, unmarked: bool = False) -> str | None:
    """Name of the snapshot modified last, the first by name among equals."""
    found = find_snapshots(spark, root, unmarked)
    return min(found, key=lambda s: (-s[1], s[0]))[0] if found else None


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, snapshot, modified)`` of every file of a snapshot below ``root``, hidden ones aside.

    ``snapshot`` is the part of the path below ``root`` up to the first name that ends in .csv. Spark lists the
    folders, in tasks where there are many, and no file is opened.
    """
    _, top = hadoop_path(spark, root)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal_path(root))
    )
    named = files.select("path", snapshot_of(top).alias("snapshot"), F.col("modificationTime").alias("modified"))
    return named.where("snapshot <> ''")


def snapshot_of(top: JavaObject, path: str = "path") -> Column:
    """The snapshot that a file below ``top`` belongs to, '' if to none."""
    below = F.expr("substring({}, {})".format(path, len(top.toString().rstrip("/")) + 2))
    # Up to the first part of the path that ends in .csv: a file, or what holds its parts.
    return F.regexp_extract(below, r"(?i)^(?:[^/]+/)*?[^/]+\.csv(?=/|$)", 0)


# How many of the newest snapshots are looked at together for one that is finished.
_NEWEST = 20


def latest_of_many(spark: SparkSession, root: str, unmarked: bool = False) -> str | None:
    """``latest_snapshot`` for folders with very many files.

    Files are listed and reduced to one time per snapshot in tasks, so that a few names reach the driver. The time
    of a directory is that of its newest part file, not of its marker; whether it has one, and so is finished, is
    asked of the newest snapshots alone, until one has, unless ``unmarked`` takes all of them.
    """
    newest = snapshot_files(spark, root).groupBy("snapshot").agg(
        F.max("modified").alias("modified"),
        F.bool_or(~F.endswith("path", F.col("snapshot"))).alias("directory"),
    )
    order = [F.desc("modified"), "snapshot"]
    seen = 0
    while True:
        rows = newest.orderBy(*order).offset(seen).limit(_NEWEST).collect()
        for row in rows:
            if unmarked or not row["directory"]:
                return row["snapshot"]
            system, marker = hadoop_path(spark, f"{root.rstrip('/')}/{row['snapshot']}/{MARKER}")
            if system.exists(marker):
                return row["snapshot"]
        if len(rows) < _NEWEST:
            return None
        seen += len(rows)


def next_snapshot_name(latest: str | None, now: datetime) -> str:
    """The first two underscore parts of the latest name and a time stamp."""
    parts = latest.split("_", 2)[:2] if latest else []
    stem = "_".join(parts) if len(parts) == 2 else "combined_data"
    return f"{stem}_{now:%Y%m%d_%H%M%S}.csv"


def known_value(column: str, na_tokens: Sequence[str]) -> str:
    """SQL for whether a text column holds more than a missing-value token."""
    quoted = ["'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in na_tokens]
    return f"`{column}` NOT IN ({', '.join(quoted)})" if quoted else "true"


def parse_fields(
    text: DataFrame, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """Turn text columns into the schema's types, missing-value tokens into NULL.

    Written as SQL text, as a tree of column objects over 64 columns and all tokens takes
    longer to build than to run.
    """
    def value(field: T.StructField) -> str:
        column = f"`{field.name}`"
        if isinstance(field.dataType, T.StringType):
            return column
        return strict_cast(column, field.dataType, f"column {field.name}")

    return text.selectExpr(
        *[
            f"CASE WHEN {known_value(f.name, na_tokens)} THEN {value(f)} END AS `{f.name}`"
            for f in schema.fields
        ]
    )


def read_snapshot(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = INCIDENT_SCHEMA,
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV file or directory, or a list of files, with a header as ``schema``.

    Columns are found by normalised name and must be exactly those of the schema.
    Values get the declared type, never an inferred one, and a value or a line that does
    not fit fails the job. ``multi_line`` allows line breaks inside quoted values; a file
    can then not be split, so such snapshots should have many files.
    """
    small_methods(spark)

    def lines():
        return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)

    given = [literal_path(p) for p in ([path] if isinstance(path, str) else path)]
    columns = lines().csv(given[:1]).columns
    header = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # Of a directory, every file must have the header of the first.
    strict = lines().schema(header).option("enforceSchema", False).option("mode", "FAILFAST")
    raw = strict.csv(given)
    return parse_fields(bind_columns(normalize_names(raw), names(schema)), schema, na_tokens)


def read_latest(
    spark: SparkSession,
    root: str,
    schema: T.StructType = INCIDENT_SCHEMA,
    unmarked: bool = False,
    **options,
) -> DataFrame:
    """The latest snapshot below ``root``, or an empty frame if there is none."""
    latest = latest_snapshot(spark, root, unmarked)
    if latest is None:
        return empty_frame(spark, schema)
    return read_snapshot(spark, f"{root.rstrip('/')}/{latest}", schema, **options)


def write_snapshot(df: DataFrame, root: str, name: str) -> str:
    """Write all of ``df`` as a directory of CSV files; fails if the name is taken."""
    path = f"{root.rstrip('/')}/{name}"
    small_methods(df.sparkSession)
    df.write.options(**CSV_OPTIONS).csv(path)
    return path

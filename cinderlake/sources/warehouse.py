"""The warehouse: Parquet tables in one folder.

Every table but the calendar keeps each load in a folder of its own. Raw and staging
folders are replaced when a load is run again under its id; dimensions and the fact are
only ever appended to, since their rows may be in use. There must be one writer at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.functions.calendar import build_dim_date
from cinderlake.functions.sql import register_functions
from cinderlake.operators.columns import load_by_position
from cinderlake.schemas import (
    DIM_DATE_SCHEMA,
    GOLD_TABLES,
    LOAD_TABLES,
    REJECT_SCHEMA,
    REJECT_TABLE,
)
from cinderlake.workspace import counted, empty_frame, hadoop_path


# Tables whose loads are replaced when they are run again.
_BY_LOAD = {**LOAD_TABLES, REJECT_TABLE: REJECT_SCHEMA}


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, *partition_by: str
) -> None:
    """Drop what is at ``path`` and put an empty table there."""
    empty = empty_frame(spark, schema)
    empty.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_rows(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Append ``df`` to a table by column position; all rows get in, or none. Returns how many."""
    observed, rows = counted(load_by_position(df, schema))
    observed.write.mode("append").parquet(path)
    return rows.get["n"]


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def folder(self, table: str, load_id: str) -> str:
        if not re.fullmatch(r"[\w.-]+", load_id, re.ASCII):
            raise ValueError(f"load id {load_id!r} has other characters than letters, digits, _.-")
        return f"{self.path(table)}/load_id={load_id}"

    def reset(self) -> None:
        """Empty every table and fill the calendar."""
        for table, schema in {**_BY_LOAD, **GOLD_TABLES}.items():
            create_table(self.spark, self.path(table), _with_load_id(schema), "load_id")
        build_dim_date(self.spark).write.mode("overwrite").parquet(self.path("dim_date"))

    def read(self, table: str) -> DataFrame:
        """A whole table; raw and staging tables have ``load_id`` as last column."""
        if table == "dim_date":
            return self.spark.read.schema(DIM_DATE_SCHEMA).parquet(self.path(table))
        if table in GOLD_TABLES:
            return self._loads(table, GOLD_TABLES[table]).drop("load_id")
        return self._loads(table, _BY_LOAD[table])

    def _loads(self, table: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(_with_load_id(schema)).parquet(self.path(table))

    def write_load(self, table: str, load_id: str, df: DataFrame) -> tuple[DataFrame, int]:
        """Write a load of a raw or staging table by position; return it as written, and its rows."""
        folder, schema = self.folder(table, load_id), _BY_LOAD[table]
        observed, rows = counted(load_by_position(df, schema))
        observed.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder), rows.get["n"]

    def append(self, table: str, load_id: str, df: DataFrame) -> int:
        """Add the rows of a load to a dimension or the fact, by position; return how many."""
        return append_rows(df, self.folder(table, load_id), GOLD_TABLES[table])

    def has(self, name: str) -> bool:
        """Whether there is a file or folder of this name, below the warehouse's own."""
        system, path = hadoop_path(self.spark, self.path(name))
        return system.exists(path)

    def read_load(self, table: str, load_id: str) -> DataFrame | None:
        """What one load added to a dimension or the fact, from its folder alone; None if nothing."""
        folder = self.folder(table, load_id)
        system, path = hadoop_path(self.spark, folder)
        if not system.exists(path):
            return None
        return self.spark.read.schema(GOLD_TABLES[table]).parquet(folder)

    def highest_key(self, table: str, surrogate_key: str) -> int:
        """The highest surrogate key in use, 0 in an empty table."""
        return self.read(table).agg(F.coalesce(F.max(surrogate_key), F.lit(0))).first()[0]

    def register_views(self) -> None:
        """Make every table available to SQL under its own name, and the functions of ``functions.sql``."""
        register_functions(self.spark)
        for table in [*_BY_LOAD, *GOLD_TABLES, "dim_date"]:
            self.read(table).createOrReplaceTempView(table)


def _with_load_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])

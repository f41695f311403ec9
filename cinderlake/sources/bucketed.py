"""Tables bucketed and sorted by their key, for targets too large to shuffle.

Rows are dealt to buckets by a hash of the key when they are written. A join on the key then reads a bucket
in one task and shuffles the other side alone, dealt to the same buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.operators.columns import load_by_position
from cinderlake.operators.joins import fits_broadcast
from cinderlake.operators.keyed import first_per_key, no_nulls
from cinderlake.workspace import counted, hadoop_path, materialize_counted


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalog whose files lie at ``path``.

    The files say by themselves which bucket they are, and a session whose catalog does not know the table is
    told of it by ``attach``, with the schema, key and buckets it was created with.
    """

    spark: SparkSession
    name: str
    path: str
    schema: T.StructType
    key: Sequence[str]
    buckets: int

    def create(self) -> None:
        """Drop what is under the name and at the path, and put an empty table there."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        system, path = hadoop_path(self.spark, self.path)
        system.delete(path, True)
        system.mkdirs(path)
        self.attach()

    def attach(self) -> None:
        """Make the table at the path known to the session's catalog, if it is not."""
        if self.spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.key)
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def read(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def append(self, rows: DataFrame) -> int:
        """Append by position, a file per bucket; all rows get in, or none. Returns how many."""
        dealt = load_by_position(rows, self.schema).repartition(self.buckets, *self.key)
        observed, seen = counted(dealt)
        writer = observed.write.mode("append").format("parquet").option("path", self.path)
        writer.bucketBy(self.buckets, *self.key).sortBy(*self.key).saveAsTable(self.name)
        return seen.get["n"]

    def new_keys(self, incoming: DataFrame) -> DataFrame:
        """The distinct keys of ``incoming``, none of them NULL, that the table lacks.

        Distinct keys, one per key and task at first, are dealt to the table's buckets and met there. Of
        the table the key columns alone are read; it is neither shuffled nor broadcast, whatever its size.
        """
        keys = list(self.key)
        wanted = incoming.select(*keys).where(no_nulls(keys)).distinct()
        present = self.read().select(*keys)
        return wanted.repartition(self.buckets, *keys).join(present.hint("merge"), keys, "left_anti")

    def fresh(
        self, incoming: DataFrame, order_by: Sequence[str | Column] | None = None
    ) -> DataFrame:
        """The rows of ``incoming`` with a key that the table lacks, the first of each key.

        Rows with a NULL key are left out. The new keys are written, and only rows with one of them
        are read in full; ``incoming`` is read twice and should be a stored table.
        """
        keys = list(self.key)
        new, count = materialize_counted(self.new_keys(incoming), "new-keys")
        side = F.broadcast(new) if fits_broadcast(new, rows=count) else new
        fresh = first_per_key(incoming.join(side, keys, "left_semi"), keys, order_by)
        return fresh.select(*incoming.columns)

    def insert(
        self, incoming: DataFrame, order_by: Sequence[str | Column] | None = None
    ) -> int:
        """Append what ``fresh`` gives; inserting the same rows again adds nothing."""
        return self.append(self.fresh(incoming, order_by))


def buckets_for(rows: int, rows_per_bucket: int = 4_000_000, least: int = 8) -> int:
    """A number of buckets for a table that is to grow to ``rows``: a power of two."""
    wanted = max(least, -(-rows // rows_per_bucket))
    return 1 << (wanted - 1).bit_length()

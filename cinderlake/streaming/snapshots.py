"""Loading snapshots as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinderlake.plans.medallion import load_incidents
from cinderlake.sources.snapshots import read_snapshot, snapshot_of
from cinderlake.sources.warehouse import Warehouse
from cinderlake.workspace import hadoop_path


def load_new_snapshots(
    warehouse: Warehouse, snapshots: str, checkpoint: str, name: str = "stream", **options
) -> StreamingQuery:
    """Load every CSV file below ``snapshots`` that no earlier run has loaded, then stop.

    The stream itself carries the names and times of new files, not their contents. Within a
    micro-batch snapshots are loaded one after the other, oldest first and by name among equals,
    so the tables come out as from loads in that order however files fall into batches.
    Each goes through the same reader, with its ``options``, and the same layers as a batch
    load. Its load id is made of the stream's name, the batch's number and its place in the batch,
    so a batch that is run again after a failure leaves the tables as they were meant to
    be; streams with checkpoints of their own need names of their own.
    """
    spark = warehouse.spark
    _, top = hadoop_path(spark, snapshots)
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .load(snapshots)
        .select("path", F.unix_micros("modificationTime").alias("modified"))
    )
    snapshot = snapshot_of(top)

    def load(batch: DataFrame, number: int) -> None:
        # One row per new file, of which Spark's own listing keeps one in the driver as well.
        found: dict[str, list] = {}
        for row in batch.withColumn("snapshot", snapshot).where("snapshot <> ''").collect():
            found.setdefault(row["snapshot"], []).append((row["modified"], row["path"]))
        order = sorted(found, key=lambda s: (max(m for m, _ in found[s]), s))
        for place, each in enumerate(order):
            paths = sorted(path for _, path in found[each])
            incidents = read_snapshot(spark, paths, **options)
            load_incidents(warehouse, incidents, f"{name}-{number}-{place}")

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Where intermediate tables go.

An intermediate that has to be read more than once with the same contents is
written as Parquet under the shared folder the cluster names in
``spark.checkpoint.dir``. The written table survives the loss of an executor and
keeps column pruning, which neither a cache nor an RDD checkpoint does. The folders are
removed by the file system when the session's process ends.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folder: tempfile.TemporaryDirectory | None = None


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of ``path`` and the path as that file system names it."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system, system.makeQualified(given)


def literal_path(path: str) -> str:
    """``path`` for Spark's readers, which take ``*?[]{}`` as patterns, to mean just itself."""
    if not any(c in path for c in "*?[]{}"):
        return path
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local master may go without one."""
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        set_on_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = set_on_context.get() if set_on_context.isDefined() else None
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="cinderlake-", ignore_cleanup_errors=True)
    return _local_folder.name


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that nobody else uses, in an empty folder that goes when the process ends."""
    above = f"{shared_folder(spark)}/cinderlake-{label}-{uuid.uuid4().hex}"
    system, path = hadoop_path(spark, above)
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{above}/{label}"


def counted(df: DataFrame, **more: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what counts its rows (``n``), and adds up ``more``, when it is next run in full."""
    observation = Observation()
    sums = [F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in more.items()]]
    return df.observe(observation, *sums), observation


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once; return the written table and its number of rows."""
    path = new_folder(df.sparkSession, label)
    observed, rows = counted(df)
    observed.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows.get["n"]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    The folder stays until the process ends, since the returned frame is lazy.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of ``schema``, without going through Python."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 0, 1, 1).select(*none)

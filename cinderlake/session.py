"""Session settings that suit this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A value that does not fit its type has to fail a load, not to become NULL.
    "spark.sql.ansi.enabled": "true",
    # The JVM does not compile methods above 8000 bytes, and the code generated for a
    # projection of 64 columns is larger. Beyond this limit Spark uses smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SPARK_LIMIT = "65535"


def small_methods(spark: SparkSession) -> None:
    """Give a session that was made elsewhere the limit on compiled methods, unless it has set one itself.

    Whatever reads, writes or draws the 64 columns calls this, as most of it is run after the call, by the caller.
    It changes how long stages take and nothing else.
    """
    if spark.conf.get(_LIMIT) == _SPARK_LIMIT:
        spark.conf.set(_LIMIT, SETTINGS[_LIMIT])


def cluster_session(app_name: str) -> SparkSession:
    """The session of a submitted job; the master and all else come from the submission."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cpus: int | str = "*", app_name: str = "cinderlake") -> SparkSession:
    """A session in this process, as the tests and the bench use it."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in {**SETTINGS, **local}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

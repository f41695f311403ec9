"""Run every query on Spark and its SQL on DuckDB and compare all rows.

``python -m checks.compare FOLDER [QUERY ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both have the same columns and rows, else what differs."""
    found = connection.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got, want = _rows(df.columns, df.collect()), _rows(columns, found.fetchall())
    if got == want:
        return ""
    extra, lacking = got - want, want - got
    return (
        f"{got.total()} rows instead of {want.total()}; {extra.total()} extra, e.g. "
        f"{next(iter(extra), None)}; {lacking.total()} lacking, e.g. {next(iter(lacking), None)}"
    )


def main(sf_dir: str, wanted: list[str]) -> int:
    from cinderlake.session import local_session

    spark: SparkSession = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(sf_dir)
    failed = 0
    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            verdict = difference(run(spark, sf_dir), connection, ORACLE_SQL[name])
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(verdict)
        print(f"{name:26} {time.time() - start:6.2f}s  {verdict or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

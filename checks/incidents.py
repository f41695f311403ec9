"""An incident snapshot derived from orders, customers and nations.

Every order becomes one incident. The mapping puts in what the load has to deal with:
texts in mixed case with blanks and tabs around them, missing keys and missing numbers,
and a text that reads as missing. It is stated twice, for Spark and for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinderlake.operators.columns import cast_columns
from cinderlake.schemas import INCIDENT_SCHEMA

_SHARED = {
    "incident_number": "o_orderkey + 100",
    "exposure_number": "o_orderkey % 2",
    "id": "o_orderkey + 1",
    "address": "c_name",
    "incident_date": "o_orderdate",
    "call_number": "o_custkey",
    "alarm_dttm": "o_orderdate + INTERVAL 1 HOUR",
    "arrival_dttm": "o_orderdate + INTERVAL 67 MINUTE",
    "close_dttm": "o_orderdate + INTERVAL 2 DAY",
    "city": "concat(' new ', lower(c_mktsegment), ' of it ')",
    "zipcode": "lpad(cast(o_custkey % 100000 AS varchar(9)), 5, '0')",
    "battalion": "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat(lower(o_orderpriority), ' ') END",
    "suppression_units": "o_orderkey % 10 + 1",
    "suppression_personnel": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 50 + 1 END",
    "ems_units": "o_custkey % 6",
    "ems_personnel": "o_custkey % 21",
    "other_units": "n_nationkey % 6",
    "other_personnel": "CASE WHEN n_nationkey = 3 THEN NULL ELSE n_nationkey % 21 END",
    "first_unit_on_scene": "o_orderstatus",
    "estimated_property_loss": "o_totalprice",
    "estimated_contents_loss": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END",
    "fire_fatalities": "o_orderkey % 3",
    "fire_injuries": "o_orderkey % 6",
    "civilian_fatalities": "o_custkey % 3",
    "civilian_injuries": "o_custkey % 6",
    "number_of_alarms": "cast(substring(o_orderpriority, 1, 1) AS bigint)",
    "primary_situation": "concat('412 - \"', c_mktsegment, '\", other')",
    "mutual_aid": "'None'",
    "supervisor_district": "n_nationkey % 11 + 1",
    "neighborhood_district": (
        "CASE WHEN n_nationkey = 7 THEN NULL WHEN o_orderstatus = 'F' THEN concat(lower(n_name), {tab})"
        " ELSE concat('  ', n_name) END"
    ),
    "point": "concat('POINT (', cast(n_nationkey AS varchar(9)), ' ', cast(o_custkey % 90 AS varchar(9)), ')')",
}


def incident_fields(tab: str) -> dict[str, str]:
    """Column -> SQL over orders, customer and nation."""
    fields = {k: v.replace("{tab}", tab) for k, v in _SHARED.items()}
    for f in INCIDENT_SCHEMA.fields:
        fields.setdefault(f.name, "'-'" if f.dataType.typeName() == "string" else "0")
    return {f.name: fields[f.name] for f in INCIDENT_SCHEMA.fields}


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation")}
    joined = (
        tables["orders"]
        .join(tables["customer"], tables["orders"].o_custkey == tables["customer"].c_custkey)
        .join(tables["nation"], tables["customer"].c_nationkey == tables["nation"].n_nationkey)
    )
    fields = incident_fields("'\\t'")
    return cast_columns(joined.selectExpr(*[f"{v} AS {k}" for k, v in fields.items()]), INCIDENT_SCHEMA)


def incidents_sql() -> str:
    """The same as a query for the check."""
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    fields = incident_fields("chr(9)")
    columns = ",\n".join(
        f"CAST({fields[f.name]} AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in INCIDENT_SCHEMA.fields
    )
    return (
        f"SELECT {columns} FROM orders JOIN customer ON o_custkey = c_custkey"
        " JOIN nation ON c_nationkey = n_nationkey"
    )

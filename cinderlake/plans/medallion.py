"""The layered load: snapshot -> raw -> staging -> dimensions and fact."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.functions.text import clean_str, first_letter_acronym
from cinderlake.operators.columns import (
    fill_nulls,
    load_by_position,
    map_strings,
    require_columns,
    require_values,
)
from cinderlake.operators.joins import Dimension, lookup_dimensions
from cinderlake.operators.keyed import (
    assign_surrogate_keys,
    distinct_dimension,
    fresh_rows,
)
from cinderlake.schemas import (
    BATTALION_FIELDS,
    DISTRICT_FIELDS,
    FACT_SCHEMA,
    INCIDENT_SCHEMA,
    MEASURES,
    RAW_INCIDENT_SCHEMA,
    REJECT_TABLE,
    STG_FACT_SCHEMA,
    names,
)
from cinderlake.sources.rejects import read_checked
from cinderlake.sources.snapshots import latest_snapshot, read_snapshot
from cinderlake.sources.warehouse import Warehouse


def raw_incidents(incidents: DataFrame) -> DataFrame:
    """Snapshot rows under the raw table's names."""
    require_columns(incidents, names(INCIDENT_SCHEMA))
    return load_by_position(incidents.select(*names(INCIDENT_SCHEMA)), RAW_INCIDENT_SCHEMA)


def raw_districts(raw: DataFrame) -> DataFrame:
    """Distinct pairs of district and city, with the smallest incident id of each."""
    return raw.groupBy(*DISTRICT_FIELDS).agg(F.min("id").alias("first_id"))


def raw_battalions(raw: DataFrame) -> DataFrame:
    return distinct_dimension(raw, BATTALION_FIELDS)


def stage_battalions(raw: DataFrame) -> DataFrame:
    return map_strings(raw)


def stage_districts(raw: DataFrame) -> DataFrame:
    """Cleaned values and the city's acronym."""
    cleaned = map_strings(raw)
    return cleaned.select(
        *DISTRICT_FIELDS, first_letter_acronym(F.col("city")).alias("city_cleaned"), "first_id"
    )


def stage_facts(raw: DataFrame) -> DataFrame:
    """The fact's columns, missing numbers as 0 and the natural keys cleaned.

    The primary key is not filled: an incident without one stops the load, before any
    dimension has grown.
    """
    keyed = require_values(raw.select(*names(STG_FACT_SCHEMA)), ["id"])
    facts = fill_nulls(keyed, ["incident_number", *MEASURES])
    return facts.withColumns(
        {c: clean_str(F.col(c)) for c in ("battalion", "neighborhood_district")}
    )


def with_dimension_keys(staged: DataFrame, battalions: DataFrame, districts: DataFrame) -> DataFrame:
    """Staged facts with surrogate keys in place of the natural keys."""
    return lookup_dimensions(
        staged,
        [
            Dimension(battalions, "battalion", "dim_battalion_sk"),
            Dimension(districts, "neighborhood_district", "dim_district_sk"),
        ],
    ).select(*names(FACT_SCHEMA))


def _grow_dimension(
    warehouse: Warehouse, table: str, load_id: str, key: str, staged: DataFrame, rows: int, order_by
) -> int:
    surrogate_key = f"{table}_sk"
    present = warehouse.read(table)
    # A NULL natural key could never be looked up, and would be new in every load.
    fresh, count = fresh_rows(
        present, staged, [key], order_by, null_keys="drop", incoming_rows=rows
    )
    if count == 0:
        return 0
    after = warehouse.highest_key(table, surrogate_key)
    numbered = assign_surrogate_keys(fresh, [key], surrogate_key, after, count)
    return warehouse.append(table, load_id, numbered.select(*present.columns))


def load_incidents(
    warehouse: Warehouse, incidents: DataFrame, load_id: str | None = None
) -> dict[str, int]:
    """Take a snapshot through all layers; return the rows each table gained.

    The snapshot is parsed once. What follows reads the raw table it was written to,
    pruned to the columns needed. A load that is repeated adds nothing to the
    dimensions and the fact, and under the same ``load_id`` it replaces its raw and
    staging rows. Any error stops the load.

    Snapshots are cumulative, so most facts are there already: their ids are compared first, and only
    new facts get their keys looked up. Of several rows with a new id the first by
    the staged columns is taken.
    """
    load_id = load_id or uuid.uuid4().hex

    def keep(table: str, df: DataFrame) -> tuple[DataFrame, int]:
        return warehouse.write_load(table, load_id, df)

    raw, _ = keep("raw_fact_fire_department", raw_incidents(incidents))
    raw_battalion, _ = keep("raw_dim_battalion", raw_battalions(raw))
    raw_district, _ = keep("raw_dim_district", raw_districts(raw))

    battalion, battalion_rows = keep("stg_dim_battalion", stage_battalions(raw_battalion))
    district, district_rows = keep("stg_dim_district", stage_districts(raw_district))
    staged, rows = keep("stg_fact_fire_department_injuries", stage_facts(raw))

    gained = {"raw_fact_fire_department": rows}
    gained["dim_battalion"] = _grow_dimension(
        warehouse, "dim_battalion", load_id, "battalion", battalion, battalion_rows, ["battalion"]
    )
    gained["dim_district"] = _grow_dimension(
        warehouse, "dim_district", load_id, "neighborhood_district", district, district_rows,
        ["first_id", "city"],
    )
    fact = "fact_fire_department_injuries"
    fresh, count = fresh_rows(
        warehouse.read(fact), staged, ["id"], null_keys="error", incoming_rows=rows
    )
    gained[fact] = 0
    if count:
        keyed = with_dimension_keys(
            fresh, warehouse.read("dim_battalion"), warehouse.read("dim_district")
        )
        gained[fact] = warehouse.append(fact, load_id, keyed)
    return gained


def load_latest(
    warehouse: Warehouse,
    snapshots: str,
    load_id: str | None = None,
    unmarked: bool = False,
    most_rejects: int | None = None,
    **options,
) -> dict[str, int]:
    """Load the latest snapshot of a folder; ``unmarked`` as for ``find_snapshots``.

    Without ``most_rejects`` the first bad line stops the load. With it, up to so many bad lines, those without
    an id among them, are written to the table of rejects and the other rows are loaded; one more stops the load before
    any table has changed.
    """
    latest = latest_snapshot(warehouse.spark, snapshots, unmarked)
    if latest is None:
        raise FileNotFoundError(f"no snapshot in {snapshots}")
    path = f"{snapshots.rstrip('/')}/{latest}"
    if most_rejects is None:
        return load_incidents(warehouse, read_snapshot(warehouse.spark, path, **options), load_id)
    load_id = load_id or uuid.uuid4().hex
    checked = read_checked(
        warehouse.spark, path, most_rejects=most_rejects, required=["id"], **options
    )
    _, faults = warehouse.write_load(REJECT_TABLE, load_id, checked.rejects)
    return {**load_incidents(warehouse, checked.rows, load_id), REJECT_TABLE: faults}

"""Column lists, types and table layouts of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


def struct(text: str) -> T.StructType:
    """Schema from lines of ``name type``."""
    pairs = [line.split() for line in text.strip().splitlines()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


# The 64 columns of an incident snapshot, in file order. The
# misspelt names are part of the file format.
INCIDENT_SCHEMA = struct("""
incident_number long
exposure_number long
id long
address string
incident_date timestamp
call_number long
alarm_dttm timestamp
arrival_dttm timestamp
close_dttm timestamp
city string
zipcode string
battalion string
station_area string
box string
suppression_units long
suppression_personnel long
ems_units long
ems_personnel long
other_units long
other_personnel long
first_unit_on_scene string
estimated_property_loss double
estimated_contents_loss double
fire_fatalities long
fire_injuries long
civilian_fatalities long
civilian_injuries long
number_of_alarms long
primary_situation string
mutual_aid string
action_taken_primary string
action_taken_secondary string
action_taken_other string
detector_alerted_occupants string
property_use string
area_of_fire_origin string
ignition_cause string
ignition_factor_primary string
ignition_factor_secondary string
heat_source string
item_first_ignited string
human_factors_associated_with_ignition string
structure_type string
structure_status string
floor_of_fire_origin string
fire_spread string
no_flame_spead string
number_of_floors_with_minimum_damage double
number_of_floors_with_significant_damage double
number_of_floors_with_heavy_damage double
number_of_floors_with_extreme_damage double
detectors_present string
detector_type string
detector_operation string
detector_effectiveness string
detector_failure_reason string
automatic_extinguishing_system_present string
automatic_extinguishing_sytem_type string
automatic_extinguishing_sytem_perfomance string
automatic_extinguishing_sytem_failure_reason string
number_of_sprinkler_heads_operating double
supervisor_district double
neighborhood_district string
point string
""")

# Snapshot columns that have another name in the raw table. The
# load is by position, so every other column keeps its name.
RAW_RENAMES = {
    "alarm_dttm": "alarm_datetime",
    "arrival_dttm": "arrival_datetime",
    "close_dttm": "close_datetime",
    "number_of_alarms": "num_alarms",
    "no_flame_spead": "no_flame_spread",
    "number_of_floors_with_minimum_damage": "num_floors_with_min_damage",
    "number_of_floors_with_significant_damage": "num_floors_with_significant_damage",
    "number_of_floors_with_heavy_damage": "num_floors_with_heavy_damage",
    "number_of_floors_with_extreme_damage": "num_floors_with_extreme_damage",
    "automatic_extinguishing_sytem_type": "automatic_extinguishing_system_type",
    "automatic_extinguishing_sytem_perfomance": "automatic_extinguishing_system_performance",
    "automatic_extinguishing_sytem_failure_reason": "automatic_extinguishing_system_failure_reason",
    "number_of_sprinkler_heads_operating": "num_sprinkler_heads_operating",
}

RAW_INCIDENT_SCHEMA = T.StructType(
    [T.StructField(RAW_RENAMES.get(f.name, f.name), f.dataType) for f in INCIDENT_SCHEMA.fields]
)

# The columns that dimensions are drawn from.
DISTRICT_FIELDS = ["neighborhood_district", "city"]
BATTALION_FIELDS = ["battalion"]

# The fields in which a new incident must differ from all others.
UNIQUE_FIELDS = ["incident_number", "id", "call_number"]

RAW_BATTALION_SCHEMA = struct("battalion string")

# ``first_id`` is the smallest incident id that carries the pair. It orders the
# first-wins rule of the district insert, which file order would leave open.
RAW_DISTRICT_SCHEMA = struct("""
neighborhood_district string
city string
first_id long
""")

STG_DISTRICT_SCHEMA = struct("""
neighborhood_district string
city string
city_cleaned string
first_id long
""")

# What the fact carries besides its keys.
_MEASURES = """
suppression_units long
suppression_personnel long
ems_units long
ems_personnel long
other_units long
other_personnel long
estimated_property_loss double
estimated_contents_loss double
fire_fatalities long
fire_injuries long
civilian_fatalities long
civilian_injuries long
num_alarms long
"""

MEASURES = names(struct(_MEASURES))

STG_FACT_SCHEMA = struct(
    "incident_number long\nid long\nincident_date timestamp\n"
    "battalion string\nneighborhood_district string" + _MEASURES
)

FACT_SCHEMA = struct(
    "incident_number long\nid long\nincident_date timestamp\n"
    "dim_battalion_sk long\ndim_district_sk long" + _MEASURES
)

DIM_BATTALION_SCHEMA = struct("""
dim_battalion_sk long
battalion string
""")

DIM_DISTRICT_SCHEMA = struct("""
dim_district_sk long
neighborhood_district string
city string
city_cleaned string
""")

# The calendar table.
DIM_DATE_SCHEMA = struct("""
date_dim_id int
date_actual date
epoch long
day_suffix string
day_name string
day_of_week int
day_of_month int
day_of_quarter int
day_of_year int
week_of_month int
week_of_year int
week_of_year_iso string
month_actual int
month_name string
month_name_abbreviated string
quarter_actual int
quarter_name string
year_actual int
first_day_of_week date
last_day_of_week date
first_day_of_month date
last_day_of_month date
first_day_of_quarter date
last_day_of_quarter date
first_day_of_year date
last_day_of_year date
mmyyyy string
mmddyyyy string
weekend_indr boolean
""")

# What was wrong with the lines of a snapshot that were rejected.
REJECT_SCHEMA = struct("""
file string
line string
column_name string
value string
reason string
""")
REJECT_TABLE = "rejected_fire_department"

# Raw and staging tables, and the tables that grow by insert-if-absent.
LOAD_TABLES = {
    "raw_fact_fire_department": RAW_INCIDENT_SCHEMA,
    "raw_dim_battalion": RAW_BATTALION_SCHEMA,
    "raw_dim_district": RAW_DISTRICT_SCHEMA,
    "stg_dim_battalion": RAW_BATTALION_SCHEMA,
    "stg_dim_district": STG_DISTRICT_SCHEMA,
    "stg_fact_fire_department_injuries": STG_FACT_SCHEMA,
}
GOLD_TABLES = {
    "dim_battalion": DIM_BATTALION_SCHEMA,
    "dim_district": DIM_DISTRICT_SCHEMA,
    "fact_fire_department_injuries": FACT_SCHEMA,
}

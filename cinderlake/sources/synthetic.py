"""Synthetic incidents with keys above those in use."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.functions import draws
from cinderlake.schemas import INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.session import small_methods

# What the generated fields are chosen from.
BATTALIONS = ("B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B09", "B10")
FIRST_UNITS = ("E01", "E02", "T01", "B01", "MED01")
SITUATIONS = (
    "412 - Gas leak (natural gas or LPG)",
    "552 - Police matter",
    "210 - Steam Rupture, steam, other",
    "522 - Water or steam leak",
    "520 - Water problem, other",
    "733 - Smoke detector activation/malfunction",
    "711 - Municipal alarm system, Street Box False",
)
ACTIONS = (
    "86 - Investigate",
    "71 - Extinguish",
    "45 - Rescue, remove from harm",
    "32 - Provide first aid & check for injuries",
    "22 - Search & rescue, other",
    "94 - Disregard",
    "12 - Fire control or extinguishment, other",
    "58 - Assist physically disabled",
    "67 - Victim impaled on object",
    "39 - Extricate victim(s) from stalled elevator",
)
PROPERTY_USES = (
    "962 - Residential street, road or residential dr",
    "960 - Street, other",
    "429 - Multifamily dwellings",
    "400 - Residential, other",
)
DISTRICTS = (
    "Financial District/South Beach",
    "Outer Richmond",
    "Hayes Valley",
    "South of Market",
    "Potrero Hill",
    "Bernal Heights",
    "Inner Sunset",
)
CITY = "SF"
NO_VALUE = "-"

# Closed ranges of the whole-number fields.
INTEGER_RANGES = {
    "exposure_number": (0, 1),
    "suppression_units": (1, 10),
    "suppression_personnel": (1, 50),
    "ems_units": (0, 5),
    "ems_personnel": (0, 20),
    "other_units": (0, 5),
    "other_personnel": (0, 20),
    "fire_fatalities": (0, 2),
    "fire_injuries": (0, 5),
    "civilian_fatalities": (0, 2),
    "civilian_injuries": (0, 5),
    "supervisor_district": (1, 11),
}
MAX_LOSS = 50_000

# Words for the free text fields, whose content has no meaning.
STREETS = ("Alder", "Birch", "Cedar", "Elm", "Juniper", "Maple", "Oak", "Willow")
STREET_KINDS = ("Avenue", "Court", "Lane", "Road", "Street", "Way")
WORDS = ("amber", "brick", "coral", "delta", "ember", "flint", "grove", "harbor")


# Fields that are drawn on their own, and those that are digits of a shared draw.
TIMES = ("incident_date", "alarm_dttm", "arrival_dttm", "close_dttm")
LOSSES = ("estimated_property_loss", "estimated_contents_loss")
COORDINATES = ("lon", "lat")
COUNTS = {f: high - low + 1 for f, (low, high) in INTEGER_RANGES.items()}
CHOICES = {
    "battalion": BATTALIONS,
    "first_unit_on_scene": FIRST_UNITS,
    "primary_situation": SITUATIONS,
    "action_taken_primary": ACTIONS,
    "property_use": PROPERTY_USES,
    "neighborhood_district": DISTRICTS,
    "station_area": WORDS,
    "box": WORDS,
    "street": STREETS,
    "street_kind": STREET_KINDS,
}
HOUSES, ZIPCODES = 9_999, 100_000


def synthetic_incidents(
    rows: DataFrame,
    row: str,
    key_count: int,
    maxima: Mapping[str, int],
    start: datetime,
    end: datetime,
    seed: int = 0,
    distinct_keys: bool = False,
) -> DataFrame:
    """One incident per row of ``rows``, with the column ``row`` kept in front.

    ``row`` numbers the rows; the draws depend on it and on ``seed`` alone. Each of the
    unique fields is drawn, with replacement, from the ``key_count`` numbers above its
    maximum, so incidents collide and have to be cleaned afterwards. With ``distinct_keys`` they are permutations
    of these numbers, so that no two incidents share one; ``row`` then counts from 0 to
    ``key_count`` - 1. The four times lie between ``start`` and ``end`` and are independent of each other.
    """
    small_methods(rows.sparkSession)
    single = [*UNIQUE_FIELDS, *TIMES, *LOSSES, *COORDINATES, "numbers", "choices", "address"]
    drawn = rows.select(row, *[draws.bits(row, seed, n).alias(f"_{n}") for n in single])
    if distinct_keys:
        drawn = drawn.drop(*[f"_{f}" for f in UNIQUE_FIELDS])
        drawn = draws.with_permutation(drawn, row, key_count, seed, [f"_{f}" for f in UNIQUE_FIELDS])

    fields: dict[str, Column] = {
        f: draws.integer(f"_{f}", maxima[f] + 1, key_count) for f in UNIQUE_FIELDS
    }
    fields |= {f: draws.timestamp(f"_{f}", start, end) for f in TIMES}
    fields |= {f: draws.double(f"_{f}", 0, MAX_LOSS) for f in LOSSES}
    for (f, (low, _)), digit in zip(
        INTEGER_RANGES.items(), draws.digits("_numbers", list(COUNTS.values()))
    ):
        fields[f] = digit + F.lit(low)
    chosen = draws.digits("_choices", [len(o) for o in CHOICES.values()])
    for (f, options), digit in zip(CHOICES.items(), chosen):
        fields[f] = draws.option(digit, options)
    house, zipcode = draws.digits("_address", [HOUSES, ZIPCODES])
    fields |= {
        "address": F.concat_ws(" ", house + F.lit(1), fields["street"], fields["street_kind"]),
        "city": F.lit(CITY),
        "zipcode": F.lpad(zipcode.cast("string"), 5, "0"),
        "number_of_alarms": F.lit(1),
        "mutual_aid": F.lit("None"),
        "point": draws.wkt_point("_lon", "_lat"),
    }
    # The rest is the same for every incident: 0 for numbers, a dash for text.
    for f in INCIDENT_SCHEMA.fields:
        blank = NO_VALUE if f.dataType.typeName() == "string" else 0
        fields.setdefault(f.name, F.lit(blank))
    return drawn.select(
        row, *[fields[f.name].cast(f.dataType).alias(f.name) for f in INCIDENT_SCHEMA.fields]
    )

"""Growing a snapshot: the latest one plus synthetic incidents, as a new snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from cinderlake.operators.quality import (
    assert_no_repeats,
    drop_colliding_rows,
    find_repeated_values,
    max_values,
)
from cinderlake.schemas import INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources.snapshots import (
    latest_snapshot,
    next_snapshot_name,
    read_snapshot,
    write_snapshot,
)
from cinderlake.sources.synthetic import synthetic_incidents
from cinderlake.workspace import materialize

# Fixed value: incidents drawn in one run, before collisions are removed.
DRAWN_ROWS = 10_000

ROW = "_draw"


def new_incidents(
    snapshot: DataFrame,
    rows: DataFrame,
    row: str,
    key_count: int,
    start: datetime,
    end: datetime,
    seed: int = 0,
    distinct_keys: bool = False,
) -> DataFrame:
    """Synthetic incidents that clash neither with the snapshot nor among each other.

    ``rows`` has one row, numbered by ``row``, for each incident to draw. With ``distinct_keys`` all of them
    stay, as no two are drawn alike; the rows are then numbered from 0 to ``key_count`` - 1.
    """
    maxima = max_values(snapshot, UNIQUE_FIELDS).first().asDict()

    def drawn(some: DataFrame) -> DataFrame:
        return synthetic_incidents(some, row, key_count, maxima, start, end, seed, distinct_keys=distinct_keys)

    if distinct_keys:
        return drawn(rows).drop(row)
    # Few rows stay when keys are drawn with replacement. They are found by their keys alone, and
    # only they are drawn in full, which gives the same again.
    keys = drawn(rows).select(row, *UNIQUE_FIELDS)
    kept = drop_colliding_rows(keys, UNIQUE_FIELDS, row_key=row).select(row)
    return drawn(rows.join(kept, row, "left_semi")).drop(row)


def grow_snapshot(
    spark: SparkSession,
    root: str,
    drawn_rows: int = DRAWN_ROWS,
    start: datetime | None = None,
    end: datetime | None = None,
    seed: int = 0,
    distinct_keys: bool = False,
) -> str:
    """Write the next snapshot below ``root`` and return its name.

    With ``distinct_keys`` all drawn incidents are added, else those that share no key. Times are drawn from the current decade up to now unless bounds are given.
    """
    now = datetime.now()
    latest = latest_snapshot(spark, root)
    if latest is None:
        raise FileNotFoundError(f"no snapshot in {root}")
    # Only an empty text is missing here: the generated 'None' has to stay as it is.
    snapshot = read_snapshot(spark, f"{root.rstrip('/')}/{latest}", INCIDENT_SCHEMA, na_tokens=())
    fresh = new_incidents(
        snapshot,
        spark.range(drawn_rows).withColumnRenamed("id", ROW),
        ROW,
        drawn_rows,
        start or datetime(now.year // 10 * 10, 1, 1),
        end or now.replace(microsecond=0),
        seed,
        distinct_keys,
    )
    # Written, as it is both checked and added to the snapshot.
    added = materialize(fresh, "incidents")
    assert_no_repeats(find_repeated_values(added, UNIQUE_FIELDS))
    name = next_snapshot_name(latest, now)
    write_snapshot(snapshot.unionByName(added), root, name)
    return name

"""Frames laid side by side, row by row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.operators.keyed import number_in_place
from cinderlake.operators.quality import repeated_by_field

_PLACE = "_place"

Order = Sequence[str | Column]


def lay_side_by_side(
    frames: Sequence[DataFrame], order_by: Sequence[Order] | None = None
) -> DataFrame:
    """All columns of all frames: row n of each beside row n of the others.

    There are as many rows as the longest frame has; a shorter one is filled up with NULL. The rows
    of a frame are taken in the order of its partitions, or of ``order_by``, which has the columns to order
    each frame by. Column names must differ over all frames. Rows are numbered in place and each
    frame is shuffled once, on its numbers; no task holds more than its part of a frame.
    """
    if not frames:
        raise ValueError("no frames to lay side by side")
    names = [c for f in frames for c in f.columns]
    repeated = sorted({c for c in names if names.count(c) > 1})
    if repeated:
        raise ValueError(f"columns of more than one frame: {repeated}")
    orders = order_by or [()] * len(frames)
    if len(orders) != len(frames):
        raise ValueError(f"{len(orders)} orders do not fit {len(frames)} frames")
    numbered = []
    for frame, order in zip(frames, orders):
        if order:
            frame = frame.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered.append(number_in_place(frame, _PLACE))
    longest = max(count for _, count in numbered)
    # Left joins from all places keep the places' partitioning, which outer joins would not.
    places = frames[0].sparkSession.range(longest).toDF(_PLACE)
    joined = reduce(lambda a, f: a.join(f[0], _PLACE, "left"), numbered, places)
    return joined.select(*[F.col("`" + c.replace("`", "``") + "`") for c in names])


def repeats_side_by_side(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """For each field two columns, ``field`` and ``field_count``: its values that occur more than once.

    Every field's values go down from the most frequent one, the smaller value first among equals and
    NULL, which counts as a value, before all others; fields with fewer of them are filled up with NULL. ``df`` is
    scanned once for all fields.
    """
    if not fields:
        return df.limit(0).select()
    report, value_of = repeated_by_field(df, fields)
    frames, orders = [], []
    for place, field in enumerate(fields, 1):
        found = report.where(F.col("field") == place).select(
            F.col(value_of[field]).alias(field), F.col("count").alias(f"{field}_count")
        )
        frames.append(found)
        orders.append((F.desc(f"{field}_count"), F.asc_nulls_first(field)))
    return lay_side_by_side(frames, orders)

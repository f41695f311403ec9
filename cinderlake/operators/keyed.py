"""Insert-if-absent, first row per key, distinct dimensions and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.operators.columns import require_values
from cinderlake.operators.joins import BROADCAST_BYTES, fits_broadcast
from cinderlake.workspace import materialize, materialize_counted


def distinct_dimension(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct rows over some columns; two NULLs count as equal here."""
    return df.select(*fields).distinct()


def no_nulls(keys: Sequence[str]) -> Column:
    """Whether none of the key columns is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The first row of every key, NULL keys forming one group.

    The order is made total by the remaining columns, so the result does not depend
    on how rows are spread. Spark keeps one row per key in each task before the
    shuffle, hence a key with very many rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*(order_by or []), *rest]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def insert_if_absent(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    null_keys: str = "keep",
    incoming_rows: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of ``incoming`` to append to ``target``: those with a key it lacks.

    Of several incoming rows with one key the first is taken. NULL keys never
    conflict, as under an SQL unique constraint; ``null_keys`` says what becomes of
    those rows: ``keep`` all, ``drop`` all, or ``error`` (a primary key).

    If the incoming keys are few, they are broadcast to the target, and those found there, no more of
    them, come back by broadcast: neither side is shuffled for the check, and nothing is written. Otherwise
    the keys that are new are found and written first, from the key columns of both sides alone.
    Only rows with a new key are shuffled in full, for the first-row rule, so a cumulative
    snapshot costs little where it brings nothing new. ``incoming`` is read twice, three times if
    NULL keys are kept and possible, and should be a stored table. ``incoming_rows`` saves counting it.
    """
    if null_keys != "error" and fits_broadcast(
        incoming.select(*keys), max_broadcast_bytes, incoming_rows
    ):
        _check_null_keys(null_keys)
        known = incoming.where(no_nulls(keys))
        few = F.broadcast(known.select(*keys))
        present = target.select(*keys).join(few, list(keys), "left_semi").distinct()
        new = known.join(F.broadcast(present), list(keys), "left_anti")
        fresh = first_per_key(new, keys, order_by).select(*incoming.columns)
        return _with_null_keys(fresh, incoming, keys, null_keys)
    fresh, _ = fresh_rows(
        target, incoming, keys, order_by, null_keys, incoming_rows, max_broadcast_bytes
    )
    return fresh


def _check_null_keys(null_keys: str) -> None:
    if null_keys not in ("keep", "drop", "error"):
        raise ValueError(f"null_keys must be keep, drop or error, not {null_keys!r}")


def _with_null_keys(
    fresh: DataFrame, incoming: DataFrame, keys: Sequence[str], null_keys: str
) -> DataFrame:
    if null_keys == "keep" and any(incoming.schema[k].nullable for k in keys):
        return fresh.unionByName(incoming.where(~no_nulls(keys)))
    return fresh


def fresh_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    null_keys: str = "keep",
    incoming_rows: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, int]:
    """What ``insert_if_absent`` returns, and how many new keys there are, which are written first."""
    _check_null_keys(null_keys)
    wanted = incoming.select(*keys)
    if null_keys == "error":
        wanted = require_values(wanted, keys)
    wanted = wanted.where(no_nulls(keys))
    present = target.select(*keys)
    if fits_broadcast(incoming.select(*keys), max_broadcast_bytes, incoming_rows):
        few = incoming.select(*keys).where(no_nulls(keys))
        present = present.join(F.broadcast(few), list(keys), "left_semi")
    new, count = materialize_counted(
        wanted.join(present, list(keys), "left_anti").distinct(), "new-keys"
    )
    # The new keys are unique, so their count bounds what is broadcast.
    if fits_broadcast(new, max_broadcast_bytes, count):
        new = F.broadcast(new)
    fresh = first_per_key(incoming.join(new, list(keys), "left_semi"), keys, order_by)
    return _with_null_keys(fresh.select(*incoming.columns), incoming, keys, null_keys), count


# Up to so many rows of a few columns are numbered in one task, without a written step.
NUMBERED_AT_ONCE = 100_000


def assign_surrogate_keys(
    rows: DataFrame,
    keys: Sequence[str],
    surrogate_key: str,
    after: int = 0,
    count: int | None = None,
) -> DataFrame:
    """Number rows after ``after`` in key order, without gaps; ``keys`` must be unique.

    A row number over all rows would sort them in one task. That is done only if ``count``
    says that there are at most NUMBERED_AT_ONCE of them. Otherwise the rows are range
    partitioned and sorted, each numbers itself inside its partition, and the
    partitions' starting points come from a running sum over one row per partition.
    The placed rows are written, so both reads see the same placement.
    """
    if count is not None and count <= NUMBERED_AT_ONCE:
        place = F.row_number().over(Window.orderBy(*keys))
        return rows.select((place + F.lit(after)).cast("bigint").alias(surrogate_key), *rows.columns)
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered, _ = number_in_place(ordered, surrogate_key, after + 1)
    return numbered.select(surrogate_key, *rows.columns)


def number_in_place(rows: DataFrame, number: str, first: int = 0) -> tuple[DataFrame, int]:
    """``rows`` with their place as column ``number``, from ``first`` up, and how many there are.

    Rows are counted through in the order of the partitions and inside them, without a sort in one
    task: the rows are written with partition and position, and partitions begin where a
    running sum over their sizes says, one row per partition.
    """
    slot = F.monotonically_increasing_id()
    placed, count = materialize_counted(rows.withColumn("_slot", slot), "placed")
    # The id of Spark's function: partition in the upper bits, position in the lower 33.
    placed = placed.withColumn("_part", F.shiftright("_slot", 33)).withColumn(
        "_position", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    # One row per partition, of which there are at most as many as tasks wrote the rows.
    place = (F.col("_start") + F.col("_position") + F.lit(first)).cast("bigint")
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.select(*rows.columns, place.alias(number)), count

"""Joins that stay balanced whatever the key distribution is."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.workspace import materialize

# A side estimated at no more than this is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

# Allowance per row and per value of fixed width, above what Spark's hash tables take.
_ROW_BYTES, _VALUE_BYTES = 32, 16

# How many of the most frequent keys get a broadcast join of their own when the
# dimension is too large to broadcast. Every key that holds more than 1/HOT_KEYS
# of the rows is among them.
HOT_KEYS = 200


def fits_broadcast(
    side: DataFrame, max_bytes: int = BROADCAST_BYTES, rows: int | None = None
) -> bool:
    """Whether all of ``side`` is estimated at no more than ``max_bytes``.

    Rows are counted and the lengths of texts are added up; without texts a count reads
    no more than the footers of a Parquet table, and none is made if ``rows`` is known.
    A side with nested columns does not count as bounded.
    """
    texts = [
        f.name for f in side.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in side.schema):
        return False
    if texts or rows is None:
        lengths = [F.coalesce(F.sum(F.octet_length(t)), F.lit(0)) for t in texts]
        total = sum(lengths, F.lit(0))
        rows, text_bytes = side.agg(F.count("*"), total).first()
    else:
        text_bytes = 0
    return rows * (_ROW_BYTES + _VALUE_BYTES * len(side.columns)) + text_bytes <= max_bytes


@dataclass(frozen=True)
class Dimension:
    """A dimension to look up: its table, its unique natural key, its surrogate key."""

    table: DataFrame
    natural_key: str
    surrogate_key: str


def lookup_dimensions(
    fact: DataFrame, dimensions: Sequence[Dimension], max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add each dimension's surrogate key; rows without a match keep a NULL key.

    The natural key must have the same name in the fact. A dimension of checked size
    is broadcast, so the fact is not shuffled. A larger one is joined by shuffle,
    after the hottest keys have been taken out; that reads the fact twice, so between
    two such joins the fact is written.
    """
    sides = [(d, d.table.select(d.natural_key, d.surrogate_key)) for d in dimensions]
    large = []
    for dim, side in sides:
        if fits_broadcast(side, max_broadcast_bytes):
            fact = fact.join(F.broadcast(side), dim.natural_key, "left")
        else:
            large.append((dim, side))
    for n, (dim, side) in enumerate(large):
        if n > 0:
            fact = materialize(fact, "looked-up")
        fact = _left_join_around_hot_keys(fact, side, dim.natural_key, dim.surrogate_key)
    return fact


def _left_join_around_hot_keys(
    fact: DataFrame, side: DataFrame, key: str, value: str, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Left join on a unique ``key`` of ``side`` when ``side`` is too large to broadcast.

    The ``hot_keys`` most frequent keys are joined by a broadcast of that many rows,
    and rows without a key need no join, so the shuffle join only sees keys of which
    none holds more than 1/hot_keys of the fact.
    """
    columns = [c for c in fact.columns if c != key]
    frequency = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    hottest = frequency.orderBy(F.desc("_n"), key).limit(hot_keys).select(key)
    matched = side.join(F.broadcast(hottest), key, "left_semi")
    hot = hottest.join(F.broadcast(matched), key, "left").select(
        key, value, F.lit(True).alias("_hot")
    )
    marked = fact.join(F.broadcast(hot), key, "left")
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    done = marked.where(settled).select(key, *columns, value)
    rest = marked.where(~settled).select(key, *columns).join(side.hint("merge"), key, "left")
    return done.unionByName(rest.select(key, *columns, value))

"""Vectors of a table as numpy rows, and which rows have a usable vector."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many numbers of a batch are looked at together.
NUMBERS_AT_ONCE = 1 << 17


def usable(column: str) -> Column:
    """Whether a vector is there, not empty, and holds only finite numbers."""

    def broken(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce(F.size(column) > 0, F.lit(False)) & ~F.coalesce(
        F.exists(column, broken), F.lit(True)
    )


def width_of(vectors: DataFrame, column: str) -> int:
    """The length most usable vectors have, the larger of two as frequent; 0 without any."""
    sizes = vectors.where(usable(column)).groupBy(F.size(column).alias("width")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    return most["width"] if most else 0


def matrices(
    batches: Iterable[pa.RecordBatch], column: str, width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with a usable vector of ``width`` numbers, and these vectors in double precision."""
    most = max(1, NUMBERS_AT_ONCE // max(1, width))
    for batch in batches:
        for at in range(0, len(batch), most):
            part = batch.slice(at, most)
            lists = part.column(column)
            lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
            flat = pc.fill_null(lists.flatten().cast(pa.float64()), np.nan)
            flat = flat.to_numpy(zero_copy_only=False)
            starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
            rows = np.flatnonzero(lengths == width)
            found = flat[starts[rows][:, None] + np.arange(width)]
            good = np.isfinite(found).all(axis=1)
            if good.any():
                yield part.take(pa.array(rows[good])), found[good]

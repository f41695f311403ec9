"""Insert-if-absent over a stream: the first row of every key, once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cinderlake.workspace import hadoop_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(values: Sequence) -> tuple:
    """An order of rows: NULL first, then by value."""
    return tuple((False, 0) if v is None else (True, v) for v in values)


def _firsts(rows: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """The rows of a table that come first under their key."""
    if rows.num_rows == 0:
        return rows
    if any(pa.types.is_nested(rows.schema.field(c).type) for c in (*keys, *order)):
        return _firsts_of_nested(rows, keys, order)
    by = [(c, "ascending") for c in (*keys, *order)]
    rows = rows.take(pc.sort_indices(rows, by, null_placement="at_start"))
    change = None
    for key in keys:
        column = rows.column(key).combine_chunks()
        one, other = column.slice(0, len(column) - 1), column.slice(1)
        differs = pc.not_equal(one, other)
        if pa.types.is_floating(column.type):
            differs = pc.and_not(differs, pc.and_(pc.is_nan(one), pc.is_nan(other)))
        change = differs if change is None else pc.or_(change, differs)
    return rows.filter(pa.chunked_array([pa.array([True]), change]))


def _firsts_of_nested(rows: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """The same for values that Arrow cannot sort."""
    best: dict[tuple, tuple] = {}
    columns = [rows.column(c).to_pylist() for c in (*keys, *order)]
    for place, values in enumerate(zip(*columns)):
        key, rank = values[: len(keys)], _rank(values[len(keys) :])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, place)
    return rows.take(pa.array(sorted(place for _, place in best.values()), pa.int64()))


# Rows that a task gathers, beside one row for every key it has met, before it reduces them.
_GATHERED = 100_000


def _reduced(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], order: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    """One row per key out of all batches of a task."""
    held, gathered, rows = None, [], 0
    for batch in batches:
        gathered.append(batch)
        rows += batch.num_rows
        if rows >= max(_GATHERED, held.num_rows if held is not None else 0):
            held = _with_more(held, gathered, keys, order)
            gathered, rows = [], 0
    if gathered:
        held = _with_more(held, gathered, keys, order)
    if held is not None:
        yield from held.to_batches(max_chunksize=10_000)


def _with_more(held: pa.Table | None, gathered: Sequence[pa.RecordBatch], keys, order) -> pa.Table:
    more = pa.Table.from_batches(gathered)
    return _firsts(more if held is None else pa.concat_tables([held, more]), keys, order)


def new_rows(
    stream: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    target: DataFrame | None = None,
) -> DataFrame:
    """The rows of a stream to append: those whose key neither ``target`` nor an earlier row has.

    Of the rows of a key that arrive in one batch the first by ``order_by`` and then the remaining columns is
    taken, NULL before all values; rows with a NULL key are left out. Keys are remembered in the state of the
    stream, which is written to its checkpoint with every batch, so a stream that is started again goes
    on where it was, and a batch that is run again gives the same rows. ``target`` is a stored table; its keys are
    compared in every batch, so it has to stay as it is.

    Every Arrow batch is reduced to one row per key before rows are shuffled on their keys, so a key with very
    many rows does not fill one task. A task then reduces what it gets to one row per key, and the state, Spark's
    own for distinct rows, lets those with a new key pass. No key costs a call of Python.
    """
    columns = stream.columns
    order = [*order_by, *[c for c in columns if c not in keys and c not in order_by]]
    known = stream.dropna(subset=list(keys))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _firsts(pa.Table.from_batches([batch]), keys, order).to_batches()

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _reduced(batches, keys, order)

    dealt = known.mapInArrow(shrink, known.schema).repartition(*keys)
    firsts = dealt.mapInArrow(reduce, known.schema)
    if target is not None:
        firsts = firsts.join(target.select(*keys).dropna(), list(keys), "left_anti").select(*columns)
    return firsts.dropDuplicates(list(keys))


def _keys_at_start(
    stream: DataFrame, checkpoint: str, keys: Sequence[str], target: DataFrame | None
) -> DataFrame | None:
    """The keys that ``target`` had when the checkpoint was new, kept beside the stream's state."""
    spark = stream.sparkSession
    folder = f"{checkpoint.rstrip('/')}/target-keys"
    system, marker = hadoop_path(spark, f"{folder}/_SUCCESS")
    if not system.exists(marker):
        _, offsets = hadoop_path(spark, f"{checkpoint.rstrip('/')}/offsets")
        if target is None or system.exists(offsets):
            return None
        target.select(*keys).dropna().distinct().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def insert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    target: DataFrame | None = None,
) -> StreamingQuery:
    """Append what ``new_rows`` lets pass to the Parquet table at ``path``, all there is now, then stop.

    The table's log says which batches are in, so no batch gets in twice. The keys of ``target`` are read when the
    checkpoint is new and not again.
    """
    spark = stream.sparkSession
    target = _keys_at_start(stream, checkpoint, keys, target)
    before = spark.conf.get(STATE_STORE)
    # Keeps the keys on disk, not in memory; a query keeps the setting that it was started with.
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        return (
            new_rows(stream, keys, order_by, target)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)

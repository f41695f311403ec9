"""Hard negatives of anchors by exact integer scores.

Each component x becomes the integer floor(scale * x). Scores are inner products of all rows with the
anchors, computed modulo several small primes in single precision and put together by the
Chinese remainder theorem (``residues``). Primes are chosen for the largest norm of any row,
which bounds every score, so scores are exact.

Anchors are cut into blocks and rows into parts, both by a hash of a row number. A cell is a block
of anchors and a part of the rows: its anchors come first and are held, its rows then stream
past them. Of each cell only the best few of every anchor leave; a window over the cells picks
the best of all. Positives come first; the scores they have then set the range in which a
second pass takes negatives. No task holds more than a block of anchors and some rows, and each
row moves once per block of anchors and pass.

Defined results: rows with a NULL vec_id or label, a vector that is NULL, empty, of another length than
most, or holds NULL or non-finite components take no part; rows that repeat a vec_id are rows
of their own (as anchors, too), but none is the positive of an anchor with its vec_id; ties in
score go to the smaller vec_id; an anchor without positives, and a positive without negatives
in range, give no rows; a component beyond 2^24 after scaling, or a squared norm beyond 2^50, is an
error; an empty table gives an empty table; only vec_id, label and embedding are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.llm.residues import primes_for, products, residues
from cinderlake.llm.vectors import matrices, width_of
from cinderlake.workspace import empty_frame, materialize

# Numbers of the anchors that one cell holds, rows that a cell has at least and at most.
_HELD = 1 << 22
_LEAST_ROWS, _MOST_ROWS = 4096, 1 << 20
# Anchors and rows whose scores are in memory at once.
_ANCHORS_AT_ONCE, _ROWS_AT_ONCE = 256, 4096
_NONE = np.iinfo(np.int64).min
_LARGEST = float(1 << 24)
OUTPUT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


def _prepared(vectors: DataFrame, width: int, scale: float) -> DataFrame:
    """row, vec_id, label, anchor, parts (integers as bytes), norm (squared): usable rows."""

    def run(batches):
        for rows, values in matrices(batches, "embedding", width):
            scaled = np.floor(values * scale)
            if np.abs(scaled).max(initial=0.0) >= _LARGEST:
                raise ValueError("an embedding holds a component that is too large for exact scores")
            whole = scaled.astype(np.int32)
            norms = (scaled * scaled).sum(axis=1).astype(np.int64)
            short = np.abs(scaled).max(axis=1, initial=0.0) < 1 << 15
            small = whole.astype(np.int16)
            blobs = [
                (small[k] if s else whole[k]).tobytes() for k, s in enumerate(short.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), rows.column("anchor"),
                 pa.array(blobs, pa.binary()), pa.array(norms)],
                names=["vec_id", "label", "anchor", "parts", "norm"],
            )

    found = vectors.mapInArrow(
        run, "vec_id long, label long, anchor boolean, parts binary, norm long"
    )
    found = found.withColumn("row", F.monotonically_increasing_id())
    return materialize(found, "components")


def _whole_rows(blobs: list[bytes], width: int) -> np.ndarray:
    out = np.empty((len(blobs), width), np.int32)
    for size, kind in ((2 * width, np.int16), (4 * width, np.int32)):
        at = [k for k, b in enumerate(blobs) if len(b) == size]
        if at:
            out[at] = np.frombuffer(b"".join(blobs[k] for k in at), kind).reshape(-1, width)
    return out


class _Cell:
    """The anchors of a cell, and the best rows so far of each of their slots."""

    def __init__(self, width: int, primes: list[int], best: int):
        self._width, self._primes, self._best = width, primes, best
        self._held: list[tuple] = []

    def hold(self, batch: pa.RecordBatch) -> None:
        names = ("row", "vec_id", "label", "parts", "marks")
        self._held.append(tuple(batch.column(n).to_pylist() for n in names))

    def close(self) -> None:
        """All anchors are there."""
        row, ids, label, blobs, marks = (
            [v for part in self._held for v in part[k]] for k in range(5)
        )
        self._held = []
        self.row = np.array(row, np.int64)
        self._ids, self._label = np.array(ids, np.int64), np.array(label, np.int64)
        self._of = residues(_whole_rows(blobs, self._width), self._primes)
        self._slots = max((len(m) for m in marks), default=0)
        # A slot that an anchor does not have gets a range that nothing is in.
        self._low = np.ones((len(ids), self._slots), np.int64)
        self._high = np.zeros((len(ids), self._slots), np.int64)
        for k, scores in enumerate(marks):
            for s, score in enumerate(scores):
                self._low[k, s], self._high[k, s] = -(-score // 2), (95 * score) // 100
        shape = (len(ids), max(1, self._slots), self._best)
        self.score, self.found = np.full(shape, _NONE), np.zeros(shape, np.int64)

    def meet(self, batch: pa.RecordBatch) -> None:
        """Score rows with all anchors and keep the best."""
        ids = batch.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        label = batch.column("label").to_numpy()[order]
        blobs = batch.column("parts").to_pylist()
        of = residues(_whole_rows([blobs[k] for k in order], self._width), self._primes)
        n = len(ids)
        # Larger is better: the score, then the earlier place, which has the smaller id.
        place = (n - 1 - np.arange(n)).astype(np.int64)
        for at in range(0, len(self.row), _ANCHORS_AT_ONCE):
            to = slice(at, at + _ANCHORS_AT_ONCE)
            score = products([r[to] for r in self._of], of, self._primes)
            key = score * n + place
            same = self._label[to, None] == label
            if not self._slots:
                key[~same | (self._ids[to, None] == ids)] = _NONE
                top = np.sort(np.partition(key, max(0, n - self._best), axis=1)[:, -self._best :])
                self._take(to, 0, top[:, ::-1], ids, n)
                continue
            key[same] = _NONE
            ranked = np.sort(key, axis=1)
            for slot in range(self._slots):
                high = (self._high[to, slot] * n + n - 1)[:, None]
                low = (self._low[to, slot] * n)[:, None]
                after = (key <= high).sum(axis=1)[:, None] - 1 - np.arange(self._best)
                chosen = np.take_along_axis(ranked, np.maximum(after, 0), axis=1)
                chosen[(after < 0) | (chosen < low) | (chosen > high)] = _NONE
                self._take(to, slot, chosen, ids, n)

    def _take(self, to: slice, slot: int, keys: np.ndarray, ids: np.ndarray, n: int) -> None:
        new = np.where(keys == _NONE, _NONE, keys // n)
        who = ids[np.where(keys == _NONE, 0, n - 1 - keys % n)]
        score = np.concatenate([self.score[to, slot], new], axis=1)
        found = np.concatenate([self.found[to, slot], who], axis=1)
        # The lowest number has no opposite, so its order is turned by complement.
        order = np.lexsort((found, ~score), axis=1)[:, : self._best]
        self.score[to, slot] = np.take_along_axis(score, order, axis=1)
        self.found[to, slot] = np.take_along_axis(found, order, axis=1)

    def rows(self) -> pa.RecordBatch:
        who, slot, place = np.nonzero(self.score != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.row[who]), pa.array(slot, pa.int32()),
             pa.array(self.found[who, slot, place]), pa.array(self.score[who, slot, place])],
            names=["row", "slot", "vec_id", "score"],
        )


def _best_of_cells(
    rows: DataFrame, anchors: DataFrame, shape: tuple[int, int], width: int, primes: list[int],
    best: int,
) -> DataFrame:
    """row, slot, vec_id, score: the best rows of each cell for every slot of its anchors."""
    blocks, parts = shape
    columns = ["cell", "kind", "row", "vec_id", "label", "parts", "marks"]
    number = F.xxhash64("row")
    held = (
        anchors.withColumn("block", F.pmod(number, F.lit(blocks)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .withColumn("kind", F.lit(0))
    )
    passing = (
        rows.withColumn("part", F.pmod(number, F.lit(parts)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumns({"kind": F.lit(1), "marks": F.array().cast("array<long>")})
    )
    cell = (F.col("block") * parts + F.col("part")).cast("long").alias("cell")
    both = [side.select(cell, *columns[1:]) for side in (held, passing)]
    dealt = both[0].unionByName(both[1]).repartition(blocks * parts, "cell")

    def run(batches):
        now, own, open_ = None, None, False
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            kinds = batch.column("kind").to_numpy()
            change = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, end in zip([0, *change.tolist()], [*change.tolist(), len(cells)]):
                if start == end:
                    continue
                if cells[start] != now:
                    if own is not None and not open_:
                        yield own.rows()
                    now, own, open_ = cells[start], _Cell(width, primes, best), True
                if not kinds[start]:
                    own.hold(batch.slice(start, end - start))
                    continue
                if open_:
                    own.close()
                    open_ = False
                for at in range(start, end, _ROWS_AT_ONCE):
                    own.meet(batch.slice(at, min(_ROWS_AT_ONCE, end - at)))
        if own is not None and not open_:
            yield own.rows()

    return dealt.sortWithinPartitions("cell", "kind").mapInArrow(
        run, "row long, slot int, vec_id long, score long"
    )


def mine(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, scale: float = 256.0
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; rows for which ``anchor`` holds are the anchors. The
    positives are the ``positives`` best other rows of the anchor's label; each gets the ``negatives`` best rows
    of other labels whose score is between 50% and 95% of the positive's.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding",
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL")
    nothing = spark.createDataFrame([], OUTPUT).schema
    width = width_of(given, "embedding")
    if not width:
        return empty_frame(spark, nothing)
    rows = _prepared(given, width, scale)
    n, many, norm = rows.agg(
        F.count("*"), F.count_if("anchor"), F.coalesce(F.max("norm"), F.lit(0))
    ).first()
    if not many:
        return empty_frame(spark, nothing)
    if norm * _ROWS_AT_ONCE >= 1 << 62:
        raise ValueError("embeddings are too long for exact 64-bit scores")
    primes = primes_for(width, max(1, norm))
    blocks = -(-many * width // _HELD)
    tasks = spark.sparkContext.defaultParallelism * 2
    size = min(max(-(-n * blocks // tasks), _LEAST_ROWS), _MOST_ROWS)
    shape = (blocks, -(-n // size))
    rows = rows.select("row", "vec_id", "label", "parts", "anchor")
    anchors = rows.where("anchor").withColumn("marks", F.array().cast("array<long>"))

    near = _best_of_cells(rows, anchors, shape, width, primes, positives)
    first = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    near = materialize(near.select("row", "place", "vec_id", "score"), "positives")

    marks = near.groupBy("row").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]
        ).alias("marks")
    )
    marked = rows.where("anchor").join(marks, "row")
    far = _best_of_cells(rows, marked, shape, width, primes, negatives)
    best = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    far = far.select(
        "row", (F.col("slot") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    near = near.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"})
    named = rows.where("anchor").select("row", F.col("vec_id").alias("anchor_id"))
    return (
        far.join(near, ["row", "place"])
        .join(named, "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")
    )

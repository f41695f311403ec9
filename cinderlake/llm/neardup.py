"""Near-duplicate vectors by cross-polytope hashing, with verified pairs.

Equal vectors are one vector from here on, held by their smallest vec_id and a weight. Each table
rotates a vector, made unit length, by three rounds of random signs and a fast Hadamard transform and
names the nearest cross-polytope corner, the largest coordinate and its sign, twice for two
independent rotations; the two corners are the bucket. A vector is in its own bucket and also looks
into the buckets of its next-best corners (multiprobe).

First only 64 signs of random projections go to the buckets with a vector's id; they tell who has no
partner in a bucket. The others go again, with their vectors. All cosines of a bucket are computed
blockwise, and only pairs at or above the threshold count; one that rounding could decide is compared
as exact fractions of the numbers as given. A pair that meets in several buckets counts in the
first of them, which follows from the codes both vectors carry, so pairs need no shuffle. Buckets
above BLOCK rows are cut into blocks, and each pair of blocks is a group of its own.

A bucket returns a row per vector that has links there: how many, and a smaller vector it is
connected with. The index is not trained; every row is in it.

Defined results: vectors that are NULL, empty, zero, of another length than most, or hold NULL or
non-finite components have no links and are their own component; a NULL vec_id takes no part and
keeps a NULL component; rows that repeat a vec_id count as vectors of their own with one id;
an empty table gives an empty table; only vec_id and embedding are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.components import connected_components
from cinderlake.workspace import materialize

TABLES = 6
PROBES = 4
BLOCK = 2048
# Cosines in double precision that are nearer to the threshold are compared as fractions.
_NEAR = 1e-9


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = rows.shape
    h = 1
    while h < width:
        rows = rows.reshape(n, width // (2 * h), 2, h)
        rows = np.stack([rows[:, :, 0] + rows[:, :, 1], rows[:, :, 0] - rows[:, :, 1]], axis=2)
        h *= 2
        rows = rows.reshape(n, width)
    return rows / np.sqrt(width)


def hash_codes(
    unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = 5
) -> np.ndarray:
    """Buckets of each vector, [rows, tables, 1 + probes]; the first is its own."""
    n, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 2, 3, width))
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    codes = np.empty((n, tables, 1 + probes), np.int32)
    reach = min(width, 1 + probes)
    for t in range(tables):
        corners, costs = [], []
        for half in range(2):
            rows = padded
            for turn in range(3):
                rows = _hadamard(rows * signs[t, half, turn])
            size = np.abs(rows)
            best = np.argpartition(-size, reach - 1, axis=1)[:, :reach]
            order = np.argsort(-np.take_along_axis(size, best, axis=1), axis=1, kind="stable")
            best = np.take_along_axis(best, order, axis=1)
            value = np.take_along_axis(rows, best, axis=1)
            corners.append(best * 2 + (value < 0))
            costs.append(np.abs(value[:, :1]) - np.abs(value))
        # The cheapest pairs of corners; the first costs nothing and is the own bucket.
        cost = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(n, -1)
        pair = (corners[0][:, :, None] * (2 * width) + corners[1][:, None, :]).reshape(n, -1)
        chosen = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
        found = np.take_along_axis(pair, chosen, axis=1)
        codes[:, t, : found.shape[1]] = found
        codes[:, t, found.shape[1] :] = found[:, :1]
    return codes


_SINGLE, _DOUBLE = b"f", b"d"


def pack_vector(values: list) -> bytes | None:
    """A vector over a power of two, exact, with its largest number from 1/2 up to 1; None if it has no direction.

    It is kept in single precision if that holds every number as it is. Equal vectors have equal bytes.
    """
    if not values or None in values:
        return None
    row = np.array(values, np.float64)
    largest = np.abs(row).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    # Adding zero turns -0.0 into 0.0.
    row = np.ldexp(row, -int(np.frexp(largest)[1])) + 0.0
    short = row.astype(np.float32)
    if (short == row).all():
        return _SINGLE + short.tobytes()
    return _DOUBLE + row.tobytes()


def unpack_vectors(blobs: list[bytes]) -> np.ndarray:
    """Vectors of one length in double precision."""
    width = (len(blobs[0]) - 1) // (4 if blobs[0][:1] == _SINGLE else 8)
    out = np.empty((len(blobs), width))
    for mark, kind in ((_SINGLE, np.float32), (_DOUBLE, np.float64)):
        at = [k for k, b in enumerate(blobs) if b[:1] == mark]
        if at:
            out[at] = np.frombuffer(b"".join(blobs[k][1:] for k in at), kind).reshape(len(at), width)
    return out


def _width(blob: bytes) -> int:
    return (len(blob) - 1) // (4 if blob[:1] == _SINGLE else 8)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def links_exactly(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the cosine of two vectors is not below the threshold, by exact fractions."""
    x, y = [Fraction(v) for v in a.tolist()], [Fraction(v) for v in b.tolist()]
    dot = sum((p * q for p, q in zip(x, y, strict=True)), Fraction(0))
    norms = sum((p * p for p in x), Fraction(0)) * sum((q * q for q in y), Fraction(0))
    limit = Fraction(repr(threshold))
    # Both sides squared, with the sign of each side.
    left, right = dot * abs(dot), limit * abs(limit) * norms
    return left >= right


def _vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, vector: vectors as ``pack_vector`` gives them, NULL where a row has none."""

    def run(batches):
        for batch in batches:
            packed = [pack_vector(values) for values in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "vector"]
            )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        run, "vec_id long, vector binary"
    )


def sketches(unit: np.ndarray, seed: int = 6) -> np.ndarray:
    """64 signs of random projections of each vector, as one number."""
    planes = np.random.default_rng(seed).normal(size=(unit.shape[1], 64))
    bits = (unit @ planes > 0).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def most_unlike(threshold: float, lost: float = 1e-5) -> int:
    """In so many of 64 signs two vectors at the threshold differ at most, but for a share ``lost``."""
    turn = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    above = 1.0
    for k in range(65):
        above -= math.comb(64, k) * turn**k * (1 - turn) ** (64 - k)
        if above <= lost:
            return k
    return 64


def _hashed(distinct: DataFrame, tables: int, probes: int) -> DataFrame:
    """rep, weight, vector, width, sketch, codes: what is known of a vector, once."""

    def run(batches):
        for batch in batches:
            by_width: dict[int, list[int]] = {}
            blobs = batch.column("vector").to_pylist()
            for i, blob in enumerate(blobs):
                by_width.setdefault(_width(blob), []).append(i)
            for width, rows in by_width.items():
                for at in range(0, len(rows), 1024):
                    some = rows[at : at + 1024]
                    unit = _unit(unpack_vectors([blobs[i] for i in some]))
                    codes = hash_codes(unit, tables, probes).reshape(len(some), -1)
                    ends = pa.array(np.arange(len(some) + 1) * codes.shape[1], pa.int32())
                    part = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("rep"), part.column("weight"), part.column("vector"),
                            pa.array(np.full(len(some), width), pa.int32()),
                            pa.array(sketches(unit)),
                            pa.ListArray.from_arrays(ends, pa.array(codes.ravel(), pa.int32())),
                        ],
                        names=["rep", "weight", "vector", "width", "sketch", "codes"],
                    )

    return distinct.select("rep", "weight", "vector").mapInArrow(
        run, "rep long, weight long, vector binary, width int, sketch long, codes array<int>"
    )


_BUCKET = ["width", "table", "bucket"]


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of whole groups, many at a time, of batches that are sorted by ``keys``."""
    held: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        same = np.ones(len(held), bool)  # the last group may go on in the next batch
        for c in keys:
            column = held.column(c).to_numpy()
            same &= column == column[-1]
        whole = int(np.flatnonzero(same)[0])
        if whole:
            yield held.slice(0, whole)
            held = held.slice(whole)
    if held is not None:
        yield held


def _groups(rows: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    change = np.zeros(len(rows), bool)
    change[0] = True
    for c in keys:
        column = rows.column(c).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    edges = [*np.flatnonzero(change).tolist(), len(rows)]
    return list(zip(edges, edges[1:]))


def _met(
    hashed: DataFrame, threshold: float, probes: int, block: int
) -> DataFrame:
    """width, table, bucket, rep, m: rows of buckets in which a vector has a partner by its sketch.

    A vector is in its own bucket and in those of its probes; two vectors meet in a bucket that is one's own and
    the other's own or probe. In a bucket of more than ``block`` rows all are taken to have a partner; it is
    then compared in m parts.
    """
    each = 1 + probes
    placed = hashed.select(
        "width", "rep", "sketch", "codes", F.posexplode("codes").alias("place", "bucket")
    )
    # Vectors with few numbers have fewer buckets than probes; a bucket counts once.
    first = f"array_position(slice(codes, place div {each} * {each} + 1, {each}), bucket) - 1"
    placed = placed.where(f"{first} = place % {each}").select(
        "width", F.expr(f"place div {each}").cast("int").alias("table"), "bucket", "rep", "sketch",
        (F.col("place") % each == 0).alias("own"),
    )
    sizes = placed.groupBy(*_BUCKET).agg(F.count("*").alias("n"))
    large = materialize(sizes.where(F.col("n") > block), "large-buckets")
    whole = placed.join(large, _BUCKET).select(
        *_BUCKET, "rep", F.ceil(F.col("n") / block).cast("int").alias("m")
    )
    small = placed.join(large.select(*_BUCKET), _BUCKET, "left_anti")
    near = most_unlike(threshold)

    def run(batches):
        for rows in _whole_groups(batches, _BUCKET):
            sketch = rows.column("sketch").to_numpy().view(np.uint64)
            own = rows.column("own").to_numpy(zero_copy_only=False)
            alive = np.zeros(len(rows), bool)
            for a, b in _groups(rows, _BUCKET):
                if b - a < 2 or not own[a:b].any():
                    continue
                owner = np.flatnonzero(own[a:b]) + a
                unlike = np.bitwise_count(sketch[owner, None] ^ sketch[a:b])
                close = unlike <= near
                close[np.arange(len(owner)), owner - a] = False
                alive[a:b] |= close.any(axis=0)
                alive[owner] |= close.any(axis=1)
            at = pa.array(np.flatnonzero(alive))
            yield pa.RecordBatch.from_arrays(
                [rows.column(c).take(at).combine_chunks() for c in (*_BUCKET, "rep")],
                names=[*_BUCKET, "rep"],
            )

    small = small.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET)
    found = small.mapInArrow(run, "width int, table int, bucket int, rep long")
    return whole.unionByName(found.withColumn("m", F.lit(1)))


def count_bucket(
    table: int, bucket: int, a: tuple, b: tuple, same: bool, threshold: float
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (positions in a, positions in b) that link and count in this bucket."""
    (ids_a, rows_a, codes_a), (ids_b, rows_b, codes_b) = a, b
    unit_a, unit_b = _unit(rows_a), _unit(rows_b)
    i, j = np.nonzero(unit_a @ unit_b.T >= threshold - _NEAR)
    if same:
        i, j = i[i < j], j[i < j]
    cosine = np.einsum("ij,ij->i", unit_a[i], unit_b[j])
    link = cosine >= threshold
    for k in np.flatnonzero(np.abs(cosine - threshold) < _NEAR).tolist():
        link[k] = links_exactly(rows_a[i[k]], rows_b[j[k]], threshold)
    i, j = i[link], j[link]
    out = []
    for at in range(0, len(i), 100_000):
        x, y = i[at : at + 100_000], j[at : at + 100_000]
        flip = ids_a[x] > ids_b[y]
        small = np.where(flip[:, None, None], codes_b[y], codes_a[x])
        large = np.where(flip[:, None, None], codes_a[x], codes_b[y])
        # Kind 0: the larger id looks into the smaller one's own bucket; kind 1: the other way.
        meets = np.stack(
            [(large == small[:, :, :1]).any(axis=2), (small == large[:, :, :1]).any(axis=2)], axis=2
        ).reshape(len(x), -1)
        first = np.where(meets.any(axis=1), meets.argmax(axis=1), -1)
        home = np.where(first % 2 == 0, small[:, table, 0], large[:, table, 0])
        counts = (first // 2 == table) & (home == bucket) & (first >= 0)
        out.append((x[counts], y[counts]))
    return out


def _lowest(count: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest place that each of ``count`` places is connected with."""
    low = np.arange(count)
    changed = bool(pairs)
    while changed:
        before = low.copy()
        for x, y in pairs:
            least = np.minimum(low[x], low[y])
            np.minimum.at(low, x, least)
            np.minimum.at(low, y, least)
        low = low[low]
        changed = bool((low != before).any())
    return low


def _links(
    distinct: DataFrame, threshold: float, tables: int, probes: int, block: int
) -> DataFrame:
    """rep, links, low: links counted in one bucket, and a vector that rep is connected with."""
    hashed = materialize(_hashed(distinct, tables, probes), "hashed-vectors")
    met = materialize(_met(hashed, threshold, probes, block), "met")
    cut = met.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    cut = cut.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    keys = [*_BUCKET, "lo", "hi"]
    cut = cut.select(*keys, "own", "rep").join(
        hashed.select("rep", "weight", "vector", "codes"), "rep"
    )
    cut = cut.repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches):
        for rows in _whole_groups(batches, keys):
            ids, own = rows.column("rep").to_numpy(), rows.column("own").to_numpy()
            weights = rows.column("weight").to_numpy()
            vectors = rows.column("vector").to_pylist()
            codes = rows.column("codes").combine_chunks().flatten().to_numpy()
            codes = codes.reshape(len(ids), tables, -1)
            table, bucket, lo, hi = (
                rows.column(c).to_numpy() for c in ("table", "bucket", "lo", "hi")
            )
            links, pairs = np.zeros(len(ids), np.int64), []
            for a, b in _groups(rows, keys):
                at = np.arange(a, b)
                same = lo[a] == hi[a]
                sides = [at, at] if same else [at[own[a:b] == v] for v in (lo[a], hi[a])]
                if min(map(len, sides)) < 1 + same:
                    continue
                parts = [(ids[k], unpack_vectors([vectors[i] for i in k]), codes[k]) for k in sides]
                for x, y in count_bucket(table[a], bucket[a], *parts, same, threshold):
                    p, q = sides[0][x], sides[1][y]
                    np.add.at(links, p, weights[q])
                    np.add.at(links, q, weights[p])
                    if len(p):
                        pairs.append((p, q))
            # Rows are in the order of their ids within a group, so the first place has the smallest.
            low = _lowest(len(ids), pairs)
            touched = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[touched]), pa.array(links[touched]), pa.array(ids[low[touched]])],
                names=["rep", "links", "low"],
            )

    return cut.mapInArrow(run, "rep long, links long, low long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, tables: int = TABLES, probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per row of ``vectors`` (vec_id, embedding)."""
    units = materialize(_vectors(vectors), "vectors")
    usable = units.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    distinct = usable.groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")
    )
    distinct = materialize(distinct, "distinct-vectors")
    found = materialize(_links(distinct, threshold, tables, probes, block), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "rep", "low")
    named = (
        distinct.join(counts, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    # Adaptive execution splits a vector that many rows share; nothing below needs it whole.
    result = units.join(named, "vector", "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0)
        .otherwise(F.coalesce("n_links", F.lit(0)))
        .cast("long")
        .alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias(
            "component_id"
        ),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Random draws that depend on nothing but a seed, a name and a row number.

``rand()`` depends on how rows fall into partitions, so a frame built on it can
change when a lost task is run again or when the frame is read twice. These draws
are a pure function of the row, so generated frames can be joined with themselves
without being written first.

Every function but ``bits`` and ``with_permutation`` turns a column of drawn bits into a value. Hashing is the
costly part, so the bits should be selected first and used afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAW_BITS = 60


def bits(row: str, seed: int, name: str) -> Column:
    """60 uniform bits as a bigint; ``row`` is the column that numbers the rows."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), F.col(row).cast("string")))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def integer(drawn: str, low: int, count: int) -> Column:
    """One of the ``count`` integers from ``low`` upwards."""
    return F.col(drawn) % F.lit(count) + F.lit(low)


def digits(drawn: str, counts: Sequence[int]) -> list[Column]:
    """Independent integers, the n-th below ``counts[n]``, out of one draw.

    They are the digits of the draw in a mixed base. The product of the counts should
    stay well below 2**60.
    """
    columns, step = [], 1
    for count in counts:
        columns.append(F.expr(f"`{drawn}` div {step} % {count}"))
        step *= count
    return columns


def double(drawn: str, low: float, high: float) -> Column:
    share = F.col(drawn).cast("double") / F.lit(float(2**DRAW_BITS))
    return share * F.lit(float(high - low)) + F.lit(float(low))


def option(index: Column, options: Sequence[str]) -> Column:
    """The option with this index, counted from 0."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + F.lit(1)).cast("int"))


def timestamp(drawn: str, start: datetime, end: datetime) -> Column:
    """A whole second from ``start`` to ``end``, both included."""
    seconds = int((end - start).total_seconds()) + 1
    first = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", integer(drawn, 0, seconds), first)


def wkt_point(drawn_lon: str, drawn_lat: str) -> Column:
    """``POINT (lon lat)`` over the whole globe, 16 decimals.

    Coordinates are counted in steps of 1e-15 degrees and scaled as decimals, so the
    text is exact and the same on every engine.
    """
    step = F.lit("0.000000000000001").cast("decimal(16,15)")

    def degrees(drawn: str, limit: int) -> Column:
        half = limit * 10**15
        steps = integer(drawn, -half, 2 * half + 1).cast("decimal(19,0)")
        return (steps * step).cast("decimal(20,16)").cast("string")

    lon, lat = degrees(drawn_lon, 180), degrees(drawn_lat, 90)
    return F.concat(F.lit("POINT ("), lon, F.lit(" "), lat, F.lit(")"))


_PASSES, _ROUNDS = 4, 2


def with_permutation(
    rows: DataFrame, row: str, count: int, seed: int, names: Sequence[str]
) -> DataFrame:
    """``rows`` with a column per name: a permutation of the row numbers 0 to ``count`` - 1.

    ``row`` numbers the rows. Different rows have different values, whatever the count, without a look at
    any other row; other seeds and names give other permutations. The largest power of two that fits
    is permuted by rounds that change half of the bits by a hash of the other half, which can be undone
    and so never join two values. All values are then turned by a third of the range and it is done
    again, until every value has been in. A row number outside the range is an error.
    """
    width = max(count, 1).bit_length() - 1
    low = width // 2
    inside = F.col(row).between(0, count - 1)
    failure = F.raise_error(F.lit(f"a row number is not between 0 and {count - 1}")).cast("bigint")
    start = F.when(inside, F.col(row).cast("bigint")).otherwise(failure)
    state = {n: f"_permuted_{k}" for k, n in enumerate(names)}
    now = rows.select("*", *[start.alias(c) for c in state.values()])
    for step in range(_PASSES * _ROUNDS):
        # A step is a projection of its own: its input is used more than once.
        now = now.withColumns(
            {c: _half_changed(c, f"{seed}|{n}|{step}", width, low, step % 2) for n, c in state.items()}
        )
        if step % _ROUNDS == _ROUNDS - 1:
            now = now.withColumns(
                {c: (F.col(c) + F.lit(count // 3)) % F.lit(count) for c in state.values()}
            )
    return now.select(*rows.columns, *[F.col(c).alias(n) for n, c in state.items()])


def _half_changed(column: str, key: str, width: int, low: int, upper: int) -> Column:
    """The column with its lower or upper bits changed by a hash of the others; larger values as they are."""
    value, mask = F.col(column), (1 << low) - 1
    if upper:
        given, free = value.bitwiseAND(F.lit(mask)), ((1 << width) - 1) ^ mask
    else:
        given, free = F.shiftright(value, low), mask
    digest = F.md5(F.concat_ws("|", F.lit(key), given.cast("string")))
    drawn = F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("bigint")
    changed = value.bitwiseXOR(drawn.bitwiseAND(F.lit(free).cast("bigint")))
    return F.when(value < F.lit(1 << width), changed).otherwise(value)

"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Deletes nothing and maps A-Z to a-z; all other bytes stay, so UTF-8 stays valid.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# What runs between two Arrow batches of one task may hold so many bytes of text at once.
BLOCK_BYTES = 4 << 20
_ROWS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8, NULL as no bytes. Reaches Python without decoding."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"")).alias(name)


def words(text: bytes) -> list[bytes]:
    """Words between the six ASCII white-space bytes, A-Z in lower case."""
    return text.translate(LOWER_ASCII).split()


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of an id's decimal text. A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns, as Python values, a part of a batch at a time."""
    for batch in batches:
        for at in range(0, len(batch), _ROWS_AT_ONCE):
            part = batch.slice(at, _ROWS_AT_ONCE)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def blocks_of(
    batches: Iterable[pa.RecordBatch], size: Callable[[tuple], int], *names: str,
    most: int = BLOCK_BYTES,
) -> Iterator[list[tuple]]:
    """Rows in lists that hold at most ``most`` by ``size``, or one row that is larger."""
    block: list[tuple] = []
    held = 0
    for row in rows_of(batches, *names):
        n = size(row)
        if block and held + n > most:
            yield block
            block, held = [], 0
        block.append(row)
        held += n
    if block:
        yield block


def parts_of(
    batches: Iterable[pa.RecordBatch], text: str, most: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Whole rows in batches whose texts have about ``most`` bytes, or one row that is longer."""
    for batch in batches:
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        starts = np.cumsum(sizes) - sizes
        at = 0
        while at < len(batch):
            end = int(np.searchsorted(starts, starts[at] + most))
            end = min(max(end, at + 1), at + _ROWS_AT_ONCE, len(batch))
            yield batch.slice(at, end - at)
            at = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... of all pieces, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such vocabularies: itself if it can be seen."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in seen}
    hidden = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


# A join side of so many rows of a few short columns is broadcast, a longer one is not.
BROADCAST_ROWS = 200_000


def without(rows: DataFrame, dropped: DataFrame, on: Column) -> DataFrame:
    """The rows that match none of ``dropped``, a written table of short columns."""
    few = dropped.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped, on, "left_anti")


class Interner(dict):
    """Word to value, computed once per word by ``make``. Forgets all when it is full.

    ``most`` bounds what is remembered, in bytes, with an allowance for each word.
    """

    _EACH = 160

    def __init__(self, make: Callable[[bytes], int], most: int = 32 << 20):
        super().__init__()
        self._make, self._most, self._held = make, most, 0

    def __missing__(self, word: bytes) -> int:
        self._held += len(word) + self._EACH
        if self._held > self._most:
            self.clear()
            self._held = len(word) + self._EACH
        value = self[word] = self._make(word)
        return value


# Of the GNU C library: the option for the size from which a block is mapped by itself.
_MMAP_THRESHOLD, _MAPPED_FROM = -3, 1 << 20


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a worker, until a ``released`` task comes that does not keep such things."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _give_back(library: ctypes.CDLL) -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def _drop_kept(library: ctypes.CDLL) -> None:
    """A function of the module, as one made in a call would reach workers with a copy of the table."""
    if _kept:
        _kept.clear()
        _give_back(library)


def released(
    run: Callable[[Iterator], Iterator], keeps: bool = False
) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, with memory that goes back once it is no longer used.

    Unless the task ``keeps`` them, what earlier tasks of other steps left to ``kept`` goes first.

    A Python worker lives on for the next tasks, and what the C library keeps of large blocks would stay
    with it, beside all other workers of the executor. Large arrays are mapped one by one, so each goes back at
    once, and the rest when the task ends.
    """

    def go(batches: Iterator) -> Iterator:
        library = ctypes.CDLL(None)
        if hasattr(library, "mallopt"):
            library.mallopt(_MMAP_THRESHOLD, _MAPPED_FROM)
        if not keeps:
            _drop_kept(library)
        try:
            yield from run(batches)
        finally:
            _give_back(library)

    return go


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let no more than ``rows`` rows go to Python at once, unless the session has a smaller bound.

    Rows are whole texts here, and a batch is held by the executor and its worker at the same time.
    """
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= rows:
        spark.conf.set(ARROW_ROWS, rows)

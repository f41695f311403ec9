"""Hierarchical packing of documents into sequences of several context sizes.

A document is routed to the smallest context size that holds it (512, 1024, 2048 or 4096
tokens). From the largest size down, a window takes one document of its own tier, whole; the gap
is filled with the largest documents of shorter tiers that fit, and what is left of
the gap with the head of a shorter document, whose tail is routed anew. Documents above the
largest size give full windows first. A full window is a power of two and so needs no
padding.

Tasks pack their own rows, block by block, so texts are not shuffled, and a task that runs again gives
the same sequences. What no task could fill a window with, less than a few windows from each, is
shuffled once and packed again, many tasks' rests together; only what is left of these is cut into
powers of two. Step groups take 16 windows of the largest size in tokens each, counted through all
tasks, so that groups differ by less than a window but for the last one.

Defined results: a NULL text counts as empty; an empty text is its end token alone; a NULL
doc_id stays NULL and is a document like any other; rows that repeat are packed each; an empty
table gives an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.llm.common import blocks_of, byte_letters, kept, ragged, released, text_bytes
from cinderlake.workspace import materialize

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
STEP_WINDOWS = 16
_BLOCK_BYTES = 2 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
# A piece with its window and the task's tokens before it, or a rest with its ids.
_PACKED = SCHEMA.replace("step_group long", "task long, before long, ids binary")
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                               "sequence_id", "offset")]
    + [("tier", pa.int32()), ("task", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())]
)
# Rests of so many tokens are packed together by one task.
_REST_TOKENS = 1 << 18


def plan_windows(
    lengths: list[int], tiers: tuple[int, ...] = TIERS, last: bool = True
) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Windows as (size, [(document, start, length)]), and the pieces left for the next block.

    Every window is full. With ``last`` nothing is left: the rest is cut into powers of two.
    """
    top = tiers[-1]
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    # Waiting pieces of each tier by (length, document, start), shortest first.
    waiting: list[list[tuple[int, int, int]]] = [[] for _ in tiers]

    def route(length: int, doc: int, start: int, at_once: bool = True) -> None:
        tier = next(k for k, size in enumerate(tiers) if length <= size)
        if at_once:
            insort(waiting[tier], (length, doc, start))
        else:
            waiting[tier].append((length, doc, start))

    for doc, n in enumerate(lengths):
        full = n // top
        windows.extend((top, [(doc, i * top, top)]) for i in range(full))
        if n % top:
            route(n % top, doc, full * top, at_once=False)
    for pieces in waiting:
        pieces.sort()

    def largest(gap: int, below: int) -> tuple[int, int, int] | None:
        for k in range(below - 1, -1, -1):
            i = bisect_right(waiting[k], (gap, 1 << 62, 0))
            if i:
                return waiting[k].pop(i - 1)
        return None

    def shortest_above(gap: int) -> tuple[int, int, int] | None:
        for pieces in waiting:
            i = bisect_right(pieces, (gap, 1 << 62, 0))
            if i < len(pieces):
                return pieces.pop(i)
        return None

    left: list[tuple[int, int, int]] = []
    for k in range(len(tiers) - 1, -1, -1):
        size = tiers[k]
        while waiting[k]:
            length, doc, start = waiting[k].pop()
            window, gap = [(doc, start, length)], size - length
            while gap:
                # Tiers below the smallest do not exist: it fills its gaps from itself.
                piece = largest(gap, max(k, 1))
                if piece is None:
                    piece = shortest_above(gap)
                    if piece is None:
                        break
                    length, doc, start = piece
                    window.append((doc, start, gap))
                    route(length - gap, doc, start + gap)
                    gap = 0
                else:
                    length, doc, start = piece
                    window.append((doc, start, length))
                    gap -= length
            if gap:
                left.extend(window)
            else:
                windows.append((size, window))
    if last and left:
        windows.extend(_powers(left))
        left = []
    return windows, left


def _powers(pieces: list[tuple[int, int, int]]) -> Iterator[tuple[int, list]]:
    """The pieces in order, cut into windows whose sizes are the binary digits of the total."""
    total = sum(n for _, _, n in pieces)
    queue = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        window, gap = [], 1 << bit
        while gap:
            doc, start, n = queue.pop()
            take = min(n, gap)
            window.append((doc, start, take))
            gap -= take
            if n > take:
                queue.append((doc, start + take, n - take))
        yield 1 << bit, window


def pack(
    docs: DataFrame, tokenizer: Callable[[], Callable[[Iterable[bytes]], tuple]],
    tiers: tuple[int, ...] = TIERS,
) -> DataFrame:
    """Pieces of documents in sequences; see SCHEMA.

    ``tokenizer`` makes, inside a task, a function from texts to (ids of all texts in a row,
    number of ids of each). The end token is added here.
    """
    if list(tiers) != sorted(tiers) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be ascending powers of two")

    def run(batches):
        encode, packer = tokenizer(), _Packer(tiers, 0)
        blocks = blocks_of(
            batches, lambda r: len(r[1]), "doc_id", "text", most=_BLOCK_BYTES
        )
        for block in blocks:
            ids, counts = encode([t for _, t in block])
            streams = []
            for (doc_id, _), end, n in zip(
                block, np.cumsum(counts).tolist(), counts.tolist(), strict=True
            ):
                own = np.empty(n + 1, "<u4")
                own[:n], own[n] = ids[end - n : end], END_ID
                streams.append((doc_id, n + 1, 0, own))
            yield packer.pack(streams, last=False)
        yield packer.rests()

    def run_rests(batches):
        packer = _Packer(tiers, 1 << 62)
        names = ("doc_id", "doc_tokens", "start", "ids")
        for block in blocks_of(batches, lambda r: len(r[3]), *names, most=_BLOCK_BYTES):
            streams = [(i, total, at, np.frombuffer(own, "<u4")) for i, total, at, own in block]
            yield packer.pack(streams, last=False)
        yield packer.pack([], last=True)

    # Written, as the texts would be encoded twice otherwise.
    first = materialize(
        docs.select("doc_id", text_bytes()).mapInArrow(released(run, keeps=True), _PACKED), "packed"
    )
    rests = first.where("ids IS NOT NULL")
    tokens = rests.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    dealt = rests.withColumn("n", F.monotonically_increasing_id()).repartition(
        max(1, -(-tokens // _REST_TOKENS)), "n"
    )
    second = materialize(
        dealt.select("doc_id", "doc_tokens", "start", "ids").mapInArrow(run_rests, _PACKED), "rests"
    )
    packed = first.where("ids IS NULL").unionByName(second)
    # Windows are counted through task by task, one row per task; the groups follow from it.
    totals = packed.groupBy("task").agg(F.max(F.col("before") + F.col("tier")).alias("tokens"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("task", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    group = F.floor((F.col("first") + F.col("before")) / (STEP_WINDOWS * tiers[-1])).cast("long")
    return packed.join(F.broadcast(starts), "task").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier",
        group.alias("step_group"),
    )


class _Packer:
    """Packs the streams of a task, (doc_id, doc_tokens, start in the document, ids), block by block."""

    def __init__(self, tiers: tuple[int, ...], above: int):
        self._tiers, self._task = tiers, above + (TaskContext.get().partitionId() << 33)
        self._windows = self._tokens = 0
        self._carried: list[tuple] = []  # the open end of the blocks so far

    def pack(self, streams: list[tuple], last: bool) -> pa.RecordBatch:
        streams = [*self._carried, *streams]
        windows, left = plan_windows([len(s[3]) for s in streams], self._tiers, last)
        self._carried = [
            (streams[d][0], streams[d][1], streams[d][2] + at, streams[d][3][at : at + n])
            for d, at, n in left
        ]
        out = []
        for size, window in windows:
            offset = 0
            for d, at, n in window:
                doc_id, total, before, own = streams[d]
                crc = zlib.crc32(own[at : at + n].tobytes())
                out.append(
                    (doc_id, before + at, n, crc, total, self._task + self._windows, offset, size,
                     self._task, self._tokens, None)
                )
                offset += n
            self._windows += 1
            self._tokens += size
        return _packed_batch(out)

    def rests(self) -> pa.RecordBatch:
        """What is left, with its ids."""
        return _packed_batch(
            [
                (doc_id, at, len(own), None, total, None, None, None, self._task, None, own.tobytes())
                for doc_id, total, at, own in self._carried
            ]
        )


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
    )


#: Fixed value: the pattern by which such vocabularies split lower-case text into pieces.
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same for texts of letters below U+0130, with the classes written out.
_LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff\u0100-\u012f"
_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LATIN_PIECE = re.compile(
    f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}\t-\r \x85\xa0]+"
)
_NOT_LATIN = re.compile("[\u0130-\U0010ffff]|<\\|")
_REMEMBERED = 400_000
_JOINED = 1000


class WordTokenizer:
    """Ids as the tokenizers library gives them for a vocabulary that drops white space.

    No token and no added token of such a vocabulary spans white space, so the ids of a text
    are those of its words one after the other. A text of Latin letters without ``<|`` is lower-cased and
    split into pieces here, and the library's merges give the ids of each piece, once per piece; words of
    other texts that hold more than such letters go to the library whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(path)
        self._split = regex.compile(_PIECE).findall
        # The same merges for pieces that are split and lower-cased already, in the letters that stand
        # for their bytes. No such letter is a space, so many go in one text.
        self._merger = Tokenizer(self._library.model)
        self._merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._letters = {b: c for b, c in enumerate(byte_letters()) if b != 32}
        self._forget()

    def _forget(self) -> None:
        self._pieces: dict[str, int] = {}
        self._ids, self._start = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)

    def _parts(self, text: bytes, whole_words: set[str]) -> list[str]:
        """Pieces of a text, and words that have to be encoded whole, which join ``whole_words``."""
        decoded = text.decode()
        if not _NOT_LATIN.search(decoded):
            return _LATIN_PIECE.findall(decoded.lower())
        out: list[str] = []
        for word in text.split():
            whole = word.decode()
            if _NOT_LATIN.search(whole):
                out.append(whole)
                whole_words.add(whole)
            else:
                out.extend(self._split(whole.lower()))
        return out

    def _learn(self, pieces: set[str], whole_words: set[str]) -> None:
        plain = list(pieces - whole_words)
        alone = list(pieces & whole_words)
        ids, counts = [self._ids], [np.zeros(0, np.int64)]
        for at in range(0, len(plain), _JOINED):
            some = plain[at : at + _JOINED]
            joined = " ".join(some).encode().decode("latin-1").translate(self._letters)
            e = self._merger.encode(joined, add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
            counts.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(some)))
        for at in range(0, len(alone), _JOINED):
            some = alone[at : at + _JOINED]
            for e in self._library.encode_batch_fast(some, add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                counts.append(np.array([len(e.ids)]))
        first = len(self._pieces)
        self._pieces.update(zip([*plain, *alone], range(first, first + len(pieces)), strict=True))
        self._ids = np.concatenate(ids)
        self._count = np.concatenate([self._count, *counts])
        self._start = np.cumsum(self._count) - self._count

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        whole_words: set[str] = set()
        parts = [self._parts(t, whole_words) for t in texts]
        unknown = set().union(*parts).difference(self._pieces)
        if self._pieces and len(self._pieces) + len(unknown) > _REMEMBERED:
            self._forget()
            unknown = set().union(*parts)
        if unknown:
            self._learn(unknown, whole_words)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        numbers = map(self._pieces.__getitem__, chain.from_iterable(parts))
        pieces = np.fromiter(numbers, np.int64, int(sizes.sum()))
        count = self._count[pieces]
        ids = self._ids[ragged(self._start[pieces], count)]
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


def word_tokenizer(path: str) -> Callable[[], WordTokenizer]:
    """For ``pack``: the tokenizer of a vocabulary file, kept in a worker from one packing task to the next."""

    return lambda: kept((WordTokenizer, path), lambda: WordTokenizer(path))

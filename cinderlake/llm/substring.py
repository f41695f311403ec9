"""Substring deduplication with compressed FM-indexes.

A passage of ``window`` words is removed from a document where it also starts in a document with a
smaller doc_id. To bring the places that may share a passage together, every window is named by
the least hash of the runs of k words in it: windows with the same words have the same
name. Neighbours with one name form a stretch. Only names that two documents have go on, and
stretches with equal words, known by a 128-bit digest, become one row with the least and the largest
doc_id that has it, in every task before anything is shuffled; its words move once. If the different stretches of a name are still too many for
one task, they are named again by longer runs of words, and at last by the whole window, where all
stretches of a name are the same.

Names are dealt to shards. A shard builds an FM-index (``fmindex``) of its stretches that could be
the origin of others, streams those that could be copies through it, and reads their matching
statistics: where a match reaches ``window`` words, all suffixes with these words stand together,
and the least doc_id among them is known. Names only bring stretches together; what is removed
rests on the words alone.

Defined results: words are runs of bytes other than the six ASCII white-space ones, unchanged;
windows are judged on the texts as they came; a NULL text has no words; a row with a NULL doc_id is
neither changed nor an origin; rows with one doc_id do not remove each other's words, as neither id
is smaller; rows that repeat both doc_id and text have equal results; a text without a removed
word still has its words joined by one space; an empty table gives an empty table; only doc_id and
text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.common import BROADCAST_ROWS, blocks_of, released, text_bytes
from cinderlake.llm.fmindex import FMIndex
from cinderlake.workspace import materialize

WINDOW = 50
# Words in the runs that name a window, one round after the other; the whole window is the last.
# Texts share shorter runs by chance, and the more so the more texts there are.
RUNS = (16, 32)
# Words of different stretches that one name may have, and that a shard has about.
NAME_WORDS = SHARD_WORDS = 200_000
# Longer stretches are streamed in parts.
_WALK = 512
# So many removed spans may be broadcast.
_BROADCAST_SPANS = 400_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FACTOR = 0x9E3779B97F4A7C15
_FACTOR_INVERSE = pow(_FACTOR, -1, 1 << 64)
_AT_ONCE = 1 << 16


class Words:
    """The words of a text, by where they begin and end."""

    def __init__(self, text: bytes):
        self.text = text
        space = np.concatenate([[True], _SPACE[np.frombuffer(text, np.uint8)], [True]])
        change = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = change[::2], change[1::2]

    def __len__(self) -> int:
        return len(self.starts)

    def parts(self, start: int, end: int) -> Iterator[list[bytes]]:
        """Words from ``start`` to ``end``, some at a time."""
        for at in range(start, end, _AT_ONCE):
            last = min(at + _AT_ONCE, end) - 1
            yield self.text[self.starts[at] : self.ends[last]].split()

    def joined(self, start: int, end: int) -> bytes:
        return b" ".join(b" ".join(part) for part in self.parts(start, end))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, from running sums over the bytes."""
        out = np.empty(len(self), np.uint64)
        data, at = np.frombuffer(self.text, np.uint8), 0
        while at < len(self):
            first = int(self.starts[at])
            # Words that end within so many bytes, or one that is longer.
            end = max(at + 1, int(np.searchsorted(self.ends, first + _AT_ONCE, "right")))
            starts, ends = self.starts[at:end] - first, self.ends[at:end] - first
            if ends[0] > _AT_ONCE:
                out[at] = xxhash.xxh3_64_intdigest(self.text[first : int(self.ends[at])])
                at = end
                continue
            powers, undo = _powers(int(ends[-1]))
            part = data[first : first + int(ends[-1])].astype(np.uint64) + np.uint64(1)
            before = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * powers[: len(part)], out=before[1:])
            out[at:end] = _mixed((before[ends] - before[starts]) * undo[starts])
            at = end
        return out


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n, or more of them, of a factor and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        for k, factor in enumerate((_FACTOR, _FACTOR_INVERSE)):
            steps = np.full(max(n, _AT_ONCE) + 1, factor, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def _mixed(sums: np.ndarray) -> np.ndarray:
    """Sums with their bits spread over all 64 places."""
    sums = sums ^ (sums >> np.uint64(32))
    sums *= np.uint64(0xD6E8FEB86659FD93)
    return sums ^ (sums >> np.uint64(29))


def names(hashes: np.ndarray, run: int, window: int) -> np.ndarray:
    """For every window of words the least of the hashes of its runs of ``run`` words."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    powers, undo = _powers(n)
    before = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers[:n], out=before[1:])
    least = _mixed((before[run:] - before[:-run]) * undo[: n - run + 1])
    width, reached = window - run + 1, 1
    while reached < width:
        step = min(reached, width - reached)
        least = np.minimum(least[:-step], least[step:])
        reached += step
    return least.view(np.int64)


def _stretches(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where neighbouring windows of one name begin and end."""
    change = np.flatnonzero(found[1:] != found[:-1]) + 1
    edges = np.concatenate([[0], change, [len(found)]]) if len(found) else np.zeros(1, np.int64)
    return edges[:-1], edges[1:]


def _named(texts: DataFrame, run: int, window: int) -> DataFrame:
    """name, doc_id, row, start: the names that each text (doc_id, row, start, text) has."""

    def go(batches):
        for block in blocks_of(batches, lambda r: len(r[3]), "doc_id", "row", "start", "text"):
            found = [
                np.unique(names(Words(t).hashes(), run, window)) for _, _, _, t in block
            ]
            of = np.repeat(np.arange(len(block)), [len(f) for f in found])
            columns = [np.array([r[k] for r in block], np.int64)[of] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (np.concatenate(found), *columns)],
                names=["name", "doc_id", "row", "start"],
            )

    return texts.mapInArrow(released(go), "name long, doc_id long, row long, start long")


_TYPES = {
    "name": pa.int64(), "doc_id": pa.int64(), "row": pa.int64(), "start": pa.int64(),
    "at": pa.int64(), "length": pa.int64(), "digest": pa.binary(), "words": pa.binary(),
}


def _batch(rows: list[tuple], *columns: str) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else [[]] * len(columns)
    arrays = [pa.array(v, _TYPES[c]) for v, c in zip(values, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _stretched(texts: DataFrame, run: int, window: int) -> DataFrame:
    """The stretches of the names in the array column ``names``, without their words.

    They lie ``at`` a word of a text (doc_id, row, start) and have ``length`` words.
    """
    columns = ("name", "doc_id", "row", "start", "at", "length", "digest")

    def go(batches):
        given = ("doc_id", "row", "start", "text", "names")
        for block in blocks_of(batches, lambda r: len(r[3]), *given):
            rows = []
            for doc_id, row, start, text, wanted in block:
                words = Words(text)
                found = names(words.hashes(), run, window)
                begin, end = _stretches(found)
                for k in np.flatnonzero(np.isin(found[begin], np.array(wanted, np.int64))).tolist():
                    a, b = int(begin[k]), int(end[k]) + window - 1
                    digest = xxhash.xxh3_128_digest(words.joined(a, b))
                    rows.append((int(found[a]), doc_id, row, start, a, b - a, digest))
            yield _batch(rows, *columns)

    return texts.mapInArrow(
        released(go), "name long, doc_id long, row long, start long, at long, length long, digest binary"
    )


def _with_words(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (name, digest, at, length in a text's doc_id, row, start) with their words, once per row."""
    key = ["doc_id", "row", "start"]
    wanted = places.groupBy(*key).agg(
        F.collect_set(F.struct("name", "digest", "at", "length")).alias("places")
    )
    columns = (*key, "name", "digest", "words")

    def go(batches):
        given = (*key, "text", "places")
        for block in blocks_of(batches, lambda r: len(r[3]), *given):
            rows = []
            for *where, text, found in block:
                words = Words(text)
                for p in found:
                    content = words.joined(p["at"], p["at"] + p["length"])
                    rows.append((*where, p["name"], p["digest"], content))
                if len(rows) >= 4096:
                    yield _batch(rows, *columns)
                    rows = []
            yield _batch(rows, *columns)

    return texts.join(wanted, key).mapInArrow(
        released(go), "doc_id long, row long, start long, name long, digest binary, words binary"
    )


def _numbers(words: Iterable[bytes], known: dict[bytes, int], new: bool) -> np.ndarray:
    """Numbers of words from 1 up; an unknown one gets the next number, or 0."""
    if new:
        return np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)
    return np.array([known.get(w, 0) for w in words], np.int64)


def search_shard(stretches: list[tuple], window: int) -> list[tuple]:
    """(name, digest, first, last, origin) of the windows that have an origin before another holder.

    ``stretches`` are (name, digest, words, least, most); ``first`` to ``last`` count windows within the
    stretch, and origin is the least doc_id that has them.
    """
    lowest: dict[int, int] = {}
    highest: dict[int, int] = {}
    for name, _, _, least, most in stretches:
        lowest[name] = min(least, lowest.get(name, least))
        highest[name] = max(most, highest.get(name, most))
    known: dict[bytes, int] = {}
    origins = [s for s in stretches if s[3] < highest[s[0]]]
    index = FMIndex([_numbers(s[2].split(), known, True) for s in origins], window)
    if not origins:
        return []
    classes, opens = index.classes(window)
    docs = np.array([s[3] for s in origins], np.int64)[index.piece]
    origin = np.minimum.reduceat(docs, opens[:-1])
    copies = [s for s in stretches if s[4] > lowest[s[0]]]
    walks, of = [], []
    for k, s in enumerate(copies):
        numbers = _numbers(s[2].split(), known, False)
        for at in range(0, len(numbers) - window + 1, _WALK):
            walks.append(numbers[at : at + _WALK + window - 1])
            of.append((k, at))
    found, where = index.matching_statistics(walks)
    out = []
    for (k, at), lengths, places in zip(of, found, where, strict=True):
        name, digest, _, _, most = copies[k]
        places = places[: len(lengths) - window + 1]
        least = origin[classes[places]]
        hit = (lengths[: len(places)] == window) & (least < most)
        least = np.where(hit, least, most)
        edges = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
        for a, b in zip(edges, edges[1:]):
            if hit[a]:
                out.append((name, digest, at + a, at + b, int(least[a])))
    return out


def _origins(distinct: DataFrame, size: int, window: int) -> DataFrame:
    """name, digest, first, last, origin from distinct stretches of ``size`` words, a shard at a time."""
    shards = -(-size // SHARD_WORDS) or 1

    def go(part: pa.Table) -> pa.Table:
        names = ("name", "digest", "words", "least", "most")
        given = list(zip(*(part.column(n).to_pylist() for n in names), strict=True))
        found = list(zip(*search_shard(given, window), strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(found, kinds, strict=True)],
            names=["name", "digest", "first", "last", "origin"],
        )

    shard = F.pmod(F.xxhash64("name"), F.lit(shards)).alias("shard")
    dealt = distinct.select(shard, "name", "digest", "words", "least", "most")
    return dealt.groupBy("shard").applyInArrow(
        go, "name long, digest binary, first long, last long, origin long"
    )


def _round(
    texts: DataFrame, run: int, window: int, final: bool
) -> tuple[DataFrame | None, DataFrame | None]:
    """Removed spans (doc_id, row, first, last in words) and the stretches left to the next round."""
    key = ["doc_id", "row", "start"]
    named = materialize(_named(texts, run, window), "names")
    shared = named.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = materialize(shared.where("a < b").select("name"), "shared")
    if shared.isEmpty():
        return None, None
    wanted = named.join(shared, "name", "left_semi").groupBy(*key)
    wanted = materialize(wanted.agg(F.collect_set("name").alias("names")), "wanted")
    holders = wanted.select(*key).distinct()
    few = wanted.count() <= BROADCAST_ROWS
    held = texts.join(F.broadcast(holders), key, "left_semi") if few else texts
    held = materialize(held.join(wanted, key), "holders")
    stretches = materialize(_stretched(held, run, window), "stretches")
    distinct = stretches.groupBy("name", "digest").agg(
        F.max("doc_id").alias("most"), F.min(F.struct(*key, "at", "length")).alias("place")
    )
    distinct = distinct.select("name", "digest", "most", "place.*")
    distinct = materialize(distinct.withColumn("least", F.col("doc_id")), "distinct")
    left = None
    if not final:
        sizes = distinct.groupBy("name").agg(F.sum("length").alias("words"))
        large = materialize(sizes.where(F.col("words") > NAME_WORDS).select("name"), "large")
        many = large.count()
        if many:
            side = F.broadcast(large) if many <= BROADCAST_ROWS else large
            distinct = distinct.join(side, "name", "left_anti")
            again = stretches.join(side, "name", "left_semi")
            # A stretch may lie in a text many times; its words are cut out once.
            once = again.groupBy(*key, "name", "digest").agg(
                F.min("at").alias("at"), F.min("length").alias("length")
            )
            left = materialize(
                _with_words(held.drop("names"), once)
                .join(again.select(*key, "name", "digest", "at"), [*key, "name", "digest"])
                .select("doc_id", "row", (F.col("start") + F.col("at")).alias("start"),
                        F.col("words").alias("text")), "left",
            )
    texts_of = _with_words(held.drop("names"), distinct).select("name", "digest", "words")
    known = distinct.select("name", "digest", "least", "most", "length")
    size = distinct.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    found = _origins(texts_of.join(known, ["name", "digest"]), size, window)
    found = materialize(found, "origins")
    spans = stretches.join(found, ["name", "digest"]).where("origin < doc_id")
    begin = F.col("start") + F.col("at")
    spans = spans.select(
        "doc_id",
        "row",
        (begin + F.col("first")).alias("first"),
        (begin + F.col("last") + window - 1).alias("last"),
    )
    return materialize(spans, "spans"), left


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as those that neither touch nor overlap, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_SPANS = "array<struct<first: long, last: long>>"
_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _merged_spans(spans: DataFrame) -> DataFrame:
    """doc_id, row, spans: the spans of each document drawn together, a row for each."""

    def go(batches):
        for rows in blocks_of(batches, lambda r: 64 * len(r[2]), "doc_id", "row", "spans"):
            drawn = [
                [{"first": a, "last": b} for a, b in merged([(s["first"], s["last"]) for s in found])]
                for _, _, found in rows
            ]
            ids = [pa.array([r[k] for r in rows], pa.int64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(drawn, _SPAN)], names=["doc_id", "row", "spans"]
            )

    one = spans.groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return one.mapInArrow(go, f"doc_id long, row long, spans {_SPANS}")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans (removed, first word to the one after the last), text (words kept).

    A row per row of ``docs`` (doc_id, text); the text is its kept words joined by one space.
    """
    texts = docs.select(F.col("doc_id").cast("long"), text_bytes())
    texts = texts.withColumns(
        {"row": F.xxhash64("doc_id", "text"), "start": F.lit(0).cast("long")}
    )
    todo, spans = texts.where("doc_id IS NOT NULL"), []
    runs = [r for r in RUNS if r < window] + [window]
    for run in runs:
        found, todo = _round(todo, run, window, final=run == window)
        if found is not None:
            spans.append(found)
        if todo is None:
            break
    if spans:
        every = spans[0]
        for more in spans[1:]:
            every = every.unionByName(more)
        every = materialize(_merged_spans(every), "removed")
        rows, many = every.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
        few = rows <= BROADCAST_ROWS and many <= _BROADCAST_SPANS
        texts = texts.join(F.broadcast(every) if few else every, ["doc_id", "row"], "left")
    else:
        texts = texts.withColumn("spans", F.lit(None).cast(_SPANS))

    def keep(batches):
        for block in blocks_of(batches, lambda r: len(r[1]), "doc_id", "text", "spans"):
            counts, removed, kept = [], [], []
            for _, text, found in block:
                words = Words(text)
                gone = [(s["first"], s["last"]) for s in found or ()]
                edges = [0, *(e for s in gone for e in s), len(words)]
                parts = [
                    words.joined(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b
                ]
                counts.append(len(words))
                removed.append([{"first": a, "last": b} for a, b in gone])
                kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in block], pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(removed, _SPAN), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "spans", "text"],
            )

    return texts.select("doc_id", "text", "spans").mapInArrow(
        keep, f"doc_id long, n_words long, spans {_SPANS}, text string"
    )

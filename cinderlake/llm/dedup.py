"""Exact deduplication by content-defined chunk recipes.

A text is cut where a hash of the last eight bytes has twelve zero bits, so equal content is
cut alike wherever it stands. Every chunk has a 128-bit key; distinct chunks are shuffled once
(one row per chunk and task) and prove that a key stands for one content. Should a key
stand for several, its contents are numbered, and key and number together identify the
chunk. A text is then its recipe, the ordered list of its chunks' identifiers, and texts
are equal when their recipes are. Long texts do not move again.

Defined results: a NULL text counts as empty; empty texts equal each other; of equal texts
the row with the largest doc_id stays (a NULL id is smaller than any other); rows that repeat
both doc_id and text count in group_size and share one verdict; an empty table gives
an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.common import released, rows_of, text_bytes
from cinderlake.workspace import materialize

SHORTEST = 2048
LONGEST = 1 << 16
_WINDOW = 8
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(52)
_SCAN = 1 << 20


def cuts(text: bytes) -> list[int]:
    """Where the chunks of a text end. Depends on nothing but the text."""
    n = len(text)
    if n <= SHORTEST:
        return [n]
    ends: list[int] = []
    for at in range(0, n - _WINDOW + 1, _SCAN):
        count = min(_SCAN, n - _WINDOW + 1 - at)
        window = np.ndarray((count,), "<u8", text, at, (1,))
        ends.extend((np.flatnonzero((window * _FACTOR) >> _SHIFT == 0) + at + _WINDOW).tolist())
    if not ends or ends[-1] != n:
        ends.append(n)
    out, start = [], 0
    for end in ends:
        out.extend(range(start + LONGEST, end, LONGEST))
        out.append(end)
        start = end
    return out


def _key(chunk: bytes, key_bytes: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:key_bytes]


def _chunks(text: bytes) -> Iterator[bytes]:
    start = 0
    for end in cuts(text):
        yield text[start:end]
        start = end


_CHUNK = pa.schema([("key", pa.binary()), ("chunk", pa.binary())])
_RECIPE = pa.schema(
    [("doc_id", pa.int64()), ("text_sha256", pa.string()), ("recipe", pa.binary())]
)
_PLACE = pa.schema(
    [("doc_id", pa.int64()), ("text_sha256", pa.string()), ("place", pa.int64()),
     ("key", pa.binary()), ("chunk", pa.binary())]
)


def _distinct_chunks(docs: DataFrame, key_bytes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = {}
            for (text,) in rows_of([batch], "text"):
                for chunk in _chunks(text):
                    found[chunk] = None
            keys = [_key(c, key_bytes) for c in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(list(found), pa.binary())], schema=_CHUNK
            )

    return docs.select(text_bytes()).mapInArrow(released(run), "key binary, chunk binary").distinct()


def _recipes(docs: DataFrame, key_bytes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, shas, recipes = [], [], []
            for doc_id, text in rows_of([batch], "doc_id", "text"):
                ids.append(doc_id)
                shas.append(hashlib.sha256(text).hexdigest())
                recipes.append(b"".join(_key(c, key_bytes) for c in _chunks(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(shas), pa.array(recipes, pa.binary())],
                schema=_RECIPE,
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(
        released(run), "doc_id long, text_sha256 string, recipe binary"
    )


def _numbered(docs: DataFrame, shared_keys: DataFrame, key_bytes: int) -> DataFrame:
    """doc_id, text_sha256, variants: the numbers of chunks whose key has several contents."""

    def run(batches):
        for batch in batches:
            rows = [
                (doc_id, hashlib.sha256(text).hexdigest(), i, _key(c, key_bytes), c)
                for doc_id, text in rows_of([batch], "doc_id", "text")
                for i, c in enumerate(_chunks(text))
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, _PLACE, strict=True)],
                schema=_PLACE,
            )

    places = docs.select("doc_id", text_bytes()).mapInArrow(
        released(run), "doc_id long, text_sha256 string, place long, key binary, chunk binary"
    )
    places = places.join(shared_keys, "key", "left_semi")
    contents = places.select("key", "chunk").distinct()
    # The number of a content is its rank by bytes among the contents of its key.
    numbers = contents.groupBy("key").agg(F.sort_array(F.collect_set("chunk")).alias("all"))
    numbers = numbers.select("key", F.posexplode("all").alias("number", "chunk"))
    found = places.join(numbers, ["key", "chunk"])
    return found.groupBy("doc_id", "text_sha256").agg(
        F.to_json(F.sort_array(F.collect_set(F.struct("place", "number")))).alias("variants")
    )


def exact_groups(docs: DataFrame, key_bytes: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    ``key_bytes`` shortens the keys of chunks; the result does not depend on it.
    """
    recipes = materialize(_recipes(docs, key_bytes), "recipes")
    shared = (
        _distinct_chunks(docs, key_bytes).groupBy("key").count().filter("count > 1").select("key")
    )
    shared = materialize(shared, "shared-keys")
    if shared.isEmpty():
        recipes = recipes.withColumn("variants", F.lit(""))
    else:
        numbered = materialize(_numbered(docs, shared, key_bytes), "variants")
        same = [recipes[c].eqNullSafe(numbered[c]) for c in ("doc_id", "text_sha256")]
        recipes = recipes.join(numbered, same, "left").select(
            recipes["*"], F.coalesce(numbered["variants"], F.lit("")).alias("variants")
        )
    groups = (
        recipes.groupBy("recipe", "variants")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    # Adaptive execution splits a recipe that many rows share; nothing below needs it whole.
    found = recipes.join(groups, ["recipe", "variants"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_sha256",
    )

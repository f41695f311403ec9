"""Synthetic incidents as a data source: ``spark.read.format("incidents")``, and as a stream.

A row is drawn from its number and the seed alone, so a partition that is read again, on any
executor, gives the same rows, and so does a batch of a stream, however rows are cut into batches. The rows are
those of ``synthetic.synthetic_incidents`` numbered from 0.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator, Mapping
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.pandas.types import to_arrow_schema

from cinderlake.functions.draws import DRAW_BITS
from cinderlake.schemas import INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources import synthetic as syn

FORMAT = "incidents"
_AT_ONCE = 8192
_PER_PARTITION = 250_000


def register_incidents(spark: SparkSession) -> None:
    """Make the format known to the session.

    Options: ``rows`` (needed), ``seed`` (0), ``start`` and ``end`` (ISO times, needed), ``partitions``, and for
    each unique field ``max_<field>`` (0), above which its keys are drawn from ``keys`` numbers (as many as
    rows). A stream has all rows at once, or, with ``rowsPerSecond`` and ``since`` (an ISO time), as
    many as that rate gives since then, up to ``rows``.
    """
    spark.dataSource.register(IncidentSource)


class _Rows(InputPartition):
    def __init__(self, first: int, end: int):
        super().__init__((first, end))
        self.first, self.end = first, end


class _Drawer:
    """Incidents by row number."""

    def __init__(self, options: Mapping[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        missing = sorted({"rows", "start", "end"} - given.keys())
        if missing:
            raise ValueError(f"the format {FORMAT} needs the options {missing}")
        self.rows = int(given["rows"])
        self.seed = int(given.get("seed", 0))
        self.keys = int(given.get("keys", self.rows))
        self.start, self.end = (datetime.fromisoformat(given[k]) for k in ("start", "end"))
        self.maxima = {f: int(given.get(f"max_{f}".lower(), 0)) for f in UNIQUE_FIELDS}
        self.partitions = int(given.get("partitions", -(-self.rows // _PER_PARTITION) or 1))
        self.rate = float(given["rowspersecond"]) if "rowspersecond" in given else None
        self.since = datetime.fromisoformat(given["since"]) if "since" in given else None
        if self.rate is not None and self.since is None:
            raise ValueError("rowsPerSecond needs since")
        if self.rows < 0 or self.partitions < 1 or self.keys < min(1, self.rows):
            raise ValueError("rows and keys must not be negative, partitions must be positive")

    def cut(self, first: int, end: int) -> list[_Rows]:
        """Even parts of a range of rows; one empty part of an empty range."""
        parts = max(1, min(self.partitions, end - first))
        edges = [first + (end - first) * k // parts for k in range(parts + 1)]
        return [_Rows(a, b) for a, b in zip(edges, edges[1:])]

    def available(self) -> int:
        if self.rate is None:
            return self.rows
        passed = max(0.0, time.time() - self.since.timestamp())
        return min(self.rows, int(passed * self.rate))

    def batches(self, part: _Rows) -> Iterator[pa.RecordBatch]:
        for first in range(part.first, part.end, _AT_ONCE):
            yield self._batch(range(first, min(first + _AT_ONCE, part.end)))

    def _bits(self, rows: range, name: str) -> np.ndarray:
        digits = DRAW_BITS // 4
        drawn = (hashlib.md5(f"{self.seed}|{name}|{r}".encode()).hexdigest()[:digits] for r in rows)
        return np.fromiter((int(d, 16) for d in drawn), np.int64, len(rows))

    def _batch(self, rows: range) -> pa.RecordBatch:
        seconds = int((self.end - self.start).total_seconds()) + 1
        first = np.datetime64(self.start, "us")
        made: dict[str, np.ndarray | list] = {}
        for f in UNIQUE_FIELDS:
            made[f] = self._bits(rows, f) % self.keys + self.maxima[f] + 1
        for f in syn.TIMES:
            made[f] = first + (self._bits(rows, f) % seconds).astype("timedelta64[s]")
        for f in syn.LOSSES:
            made[f] = self._bits(rows, f).astype(np.float64) / 2.0**DRAW_BITS * float(syn.MAX_LOSS)
        numbers = _digits(self._bits(rows, "numbers"), list(syn.COUNTS.values()))
        for (f, (low, _)), digit in zip(syn.INTEGER_RANGES.items(), numbers):
            made[f] = digit + low
        chosen = _digits(self._bits(rows, "choices"), [len(o) for o in syn.CHOICES.values()])
        for (f, options), digit in zip(syn.CHOICES.items(), chosen):
            made[f] = np.array(options, object)[digit]
        house, zipcode = _digits(self._bits(rows, "address"), [syn.HOUSES, syn.ZIPCODES])
        made["address"] = [
            f"{h + 1} {s} {k}" for h, s, k in zip(house, made["street"], made["street_kind"])
        ]
        made["zipcode"] = [f"{z:05d}" for z in zipcode]
        made["point"] = [
            f"POINT ({x} {y})"
            for x, y in zip(_degrees(self._bits(rows, "lon"), 180), _degrees(self._bits(rows, "lat"), 90))
        ]
        fixed = {"city": syn.CITY, "number_of_alarms": 1, "mutual_aid": "None"}
        schema = to_arrow_schema(INCIDENT_SCHEMA)
        arrays = []
        for field in schema:
            blank = syn.NO_VALUE if pa.types.is_string(field.type) else 0
            values = made.get(field.name)
            if values is None:
                values = [fixed.get(field.name, blank)] * len(rows)
            arrays.append(pa.array(values, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _digits(drawn: np.ndarray, counts: list[int]) -> list[np.ndarray]:
    out = []
    for count in counts:
        out.append(drawn % count)
        drawn = drawn // count
    return out


def _degrees(drawn: np.ndarray, limit: int) -> Iterator[str]:
    half = limit * 10**15
    for steps in (drawn % (2 * half + 1) - half).tolist():
        whole, rest = divmod(abs(steps), 10**15)
        yield f"{'-' if steps < 0 else ''}{whole}.{rest:015d}0"


class IncidentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return INCIDENT_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(_Drawer(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(_Drawer(self.options))


class _Reader(DataSourceReader):
    def __init__(self, drawer: _Drawer):
        self._drawer = drawer

    def partitions(self) -> list[_Rows]:
        return self._drawer.cut(0, self._drawer.rows)

    def read(self, partition: _Rows) -> Iterator[pa.RecordBatch]:
        return self._drawer.batches(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are row numbers, so a stream that starts again goes on with the next row."""

    def __init__(self, drawer: _Drawer):
        self._drawer = drawer

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": self._drawer.available()}

    def partitions(self, start: dict, end: dict) -> list[_Rows]:
        return self._drawer.cut(start["row"], end["row"])

    def read(self, partition: _Rows) -> Iterator[pa.RecordBatch]:
        return self._drawer.batches(partition)

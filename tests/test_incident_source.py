"""Incidents as a data source, in batches and as a stream."""

from datetime import datetime, timezone

import pytest

from cinderlake.functions import draws
from cinderlake.schemas import INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources import synthetic as syn
from cinderlake.sources.incident_source import FORMAT, _Drawer, register_incidents
from cinderlake.sources.synthetic import synthetic_incidents

START, END = datetime(2020, 1, 1), datetime(2021, 6, 1, 12)
OPTIONS = {"rows": 700, "seed": 5, "start": START.isoformat(), "end": END.isoformat(),
           **{f"max_{f}": 1000 * n for n, f in enumerate(UNIQUE_FIELDS)}}


def read(spark, **more):
    register_incidents(spark)
    return spark.read.format(FORMAT).options(**{**OPTIONS, **more}).load()


def expressions(spark, rows=700):
    maxima = {f: 1000 * n for n, f in enumerate(UNIQUE_FIELDS)}
    made = synthetic_incidents(spark.range(rows).toDF("row"), "row", 700, maxima, START, END, 5)
    return sorted(map(tuple, made.drop("row").collect()))


def test_rows_are_those_of_the_expressions(spark):
    frame = read(spark)
    assert frame.schema == INCIDENT_SCHEMA
    want = expressions(spark)
    assert sorted(map(tuple, frame.collect())) == want
    dealt = read(spark, partitions=7)
    assert dealt.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, dealt.collect())) == want


def test_a_part_that_is_read_again_is_the_same():
    drawer = _Drawer({k: str(v) for k, v in OPTIONS.items()} | {"partitions": "3"})
    for part in drawer.cut(0, 700):
        one, two = (list(drawer.batches(part)) for _ in range(2))
        assert one == two
    assert [(p.first, p.end) for p in drawer.cut(10, 11)] == [(10, 11)]
    assert [(p.first, p.end) for p in drawer.cut(5, 5)] == [(5, 5)]


def test_no_rows_and_wrong_options(spark):
    assert read(spark, rows=0).count() == 0
    with pytest.raises(Exception, match="needs the options"):
        register_incidents(spark)
        spark.read.format(FORMAT).options(rows=3).load().collect()
    with pytest.raises(Exception, match="needs since"):
        read(spark, rowsPerSecond=3).collect()


def test_a_stream_goes_on_where_it_was(spark, tmp_path):
    register_incidents(spark)

    def run(**more):
        stream = spark.readStream.format(FORMAT).options(**{**OPTIONS, "partitions": 2, **more}).load()
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(once=True).start()
        )
        query.awaitTermination()
        return sorted(map(tuple, spark.read.schema(INCIDENT_SCHEMA).parquet(str(tmp_path / "out")).collect()))

    assert run(rows=300, keys=700) == expressions(spark, 300)
    assert run() == expressions(spark)
    assert run() == expressions(spark)


def test_rows_by_the_clock():
    options = {k: str(v) for k, v in OPTIONS.items()}
    long_ago = datetime(2020, 1, 1, tzinfo=timezone.utc).isoformat()
    assert _Drawer(options | {"rowsPerSecond": "1", "since": long_ago}).available() == 700
    assert _Drawer(options | {"rowsPerSecond": "1", "since": "2999-01-01"}).available() == 0


def test_fixed_values():
    """Stated once more, so that a change of the generator's lists and ranges does not go unseen."""
    assert draws.DRAW_BITS == 60 and syn.MAX_LOSS == 50_000
    assert syn.BATTALIONS == tuple(f"B{n:02d}" for n in range(1, 11))
    assert syn.FIRST_UNITS == ("E01", "E02", "T01", "B01", "MED01")
    assert [len(o) for o in (syn.SITUATIONS, syn.ACTIONS, syn.PROPERTY_USES, syn.DISTRICTS)] == [7, 10, 4, 7]
    assert syn.INTEGER_RANGES == {
        "exposure_number": (0, 1), "suppression_units": (1, 10), "suppression_personnel": (1, 50),
        "ems_units": (0, 5), "ems_personnel": (0, 20), "other_units": (0, 5), "other_personnel": (0, 20),
        "fire_fatalities": (0, 2), "fire_injuries": (0, 5), "civilian_fatalities": (0, 2),
        "civilian_injuries": (0, 5), "supervisor_district": (1, 11),
    }
    assert (syn.CITY, syn.NO_VALUE) == ("SF", "-")
    assert UNIQUE_FIELDS == ["incident_number", "id", "call_number"]

"""Marts in one scan and marts from sums, against the marts one by one."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cinderlake.plans import daily, marts
from cinderlake.plans.medallion import load_incidents
from cinderlake.schemas import FACT_SCHEMA, INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources.synthetic import synthetic_incidents
from cinderlake.sources.warehouse import Warehouse

NUMBERS = ["incident_count", "avg_alarms", "total_property_loss", "avg_personnel_response",
           "percentage_fatalities"]


@pytest.fixture(scope="module")
def fact(spark):
    start = datetime(2019, 12, 25)
    rows = []
    for i in range(600):
        when = start + timedelta(days=i * 7 % 400, hours=i % 5 and 0 or i % 3)
        rows.append((i, i, when, 1, 1, i % 4, i % 7 if i % 11 else None, 0, i % 3, 0, i % 5,
                     float(i % 50) if i % 13 else None, 0.0, i % 2, 0, i % 3 if i % 17 else None, 0,
                     i % 6 if i % 19 else None))
    rows.append((601, 601, None, *[1] * 8, 1.0, 1.0, *[1] * 5))
    return spark.createDataFrame(rows, FACT_SCHEMA).repartition(4)


def one_by_one(fact, **join):
    made = {
        "incidents_by_weekday": marts.incidents_by_weekday(fact, **join),
        "average_alarms_by_month": marts.average_alarms_by_month(fact, **join),
        "property_loss_by_quarter": marts.property_loss_by_quarter(fact, **join),
        "response_by_year": marts.response_by_year(fact, **join),
        "fatality_rate_by_weekend": marts.fatality_rate_by_weekend(fact, **join),
    }
    out = {}
    for mart, frame in made.items():
        for r in frame.collect():
            label = r[0] if isinstance(r[0], str) else str(r[0]).lower()
            out[mart, label] = [r[n] if n in frame.columns else None for n in NUMBERS]
    return out


def stacked(frame):
    return {(r.mart, r.label): [r[n] for n in NUMBERS] for r in frame.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key, numbers in want.items():
        assert [n is None for n in got[key]] == [n is None for n in numbers], key
        assert [n for n in got[key] if n is not None] == pytest.approx([n for n in numbers if n is not None])


def test_one_scan_gives_the_marts(fact):
    same(stacked(marts.marts_in_one_scan(fact)), one_by_one(fact))
    same(stacked(marts.marts_in_one_scan(fact, by_day=True)), one_by_one(fact, by_day=True))
    found = marts.marts_in_one_scan(fact).where("mart = 'incidents_by_weekday'").orderBy("place")
    assert [r.place for r in found.collect()] == list(range(1, 8))


def test_one_scan_and_one_shuffle(spark, fact, tmp_path, plan_text):
    fact.write.parquet(str(tmp_path / "fact"))
    plan = plan_text(marts.marts_in_one_scan(spark.read.parquet(str(tmp_path / "fact"))))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange") == plan.count("BroadcastExchange") + 1
    assert plan.index("partial_") > plan.index("Exchange hashpartitioning")


def test_sums_of_parts_give_the_marts(fact):
    parts = [daily.sums_by_day(fact.where(F.col("id") % 3 == k)) for k in range(3)]
    sums = parts[0].unionByName(parts[1]).unionByName(parts[2])
    same(stacked(daily.grouped_marts(sums)), one_by_one(fact))
    assert daily.top_days_by_alarms(sums).collect() == marts.top_days_by_alarms(fact).collect()
    by_day = daily.sums_by_day(fact, by_day=True)
    same(stacked(daily.grouped_marts(by_day)), one_by_one(fact, by_day=True))
    assert daily.merged(sums).count() == parts[0].unionByName(parts[1]).unionByName(parts[2]).select("day").distinct().count()


def test_nothing_at_all(fact):
    none = fact.limit(0)
    assert marts.marts_in_one_scan(none).count() == 0
    assert daily.grouped_marts(daily.sums_by_day(none)).count() == 0


def test_marts_after_three_loads(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.reset()
    assert daily.grouped_marts(daily.sums_of_loads(warehouse)).count() == 0
    drawn = synthetic_incidents(
        spark.range(300).toDF("row"), "row", 300, dict.fromkeys(UNIQUE_FIELDS, 0), datetime(2020, 1, 1),
        datetime(2021, 1, 1), 3, distinct_keys=True,
    )
    drawn = drawn.withColumn("incident_date", F.date_trunc("day", "incident_date").cast("timestamp_ntz"))
    snapshots = [drawn.where(f"row < {n}").select(*[f.name for f in INCIDENT_SCHEMA.fields]) for n in (100, 180, 300)]
    for n, snapshot in enumerate(snapshots):
        gained = load_incidents(warehouse, snapshot, f"load{n}")["fact_fire_department_injuries"]
        assert gained == (100, 80, 120)[n]
        assert 0 < daily.add_load(warehouse, f"load{n}") <= gained
        same(stacked(daily.grouped_marts(daily.sums_of_loads(warehouse))),
             one_by_one(warehouse.read("fact_fire_department_injuries")))
    # Adding a load again changes nothing, a load without new facts adds nothing.
    daily.add_load(warehouse, "load1")
    load_incidents(warehouse, snapshots[2], "again")
    assert daily.add_load(warehouse, "again") == 0
    sums = daily.sums_of_loads(warehouse)
    same(stacked(daily.grouped_marts(sums)), one_by_one(warehouse.read("fact_fire_department_injuries")))
    # The marts read the sums alone, and adding a load reads that load's folder alone.
    read = {os.path.dirname(f.split("warehouse/")[1]).split("/")[0] for f in sums.inputFiles()}
    assert read == {daily.TABLE}
    files = warehouse.read_load("fact_fire_department_injuries", "load2").inputFiles()
    assert files and all("load_id=load2" in f for f in files)
    assert glob.glob(str(tmp_path / "warehouse" / daily.TABLE / "load_id=load2"))

"""Reading snapshots with bad lines, and loading what is good of them."""

from datetime import datetime

import pytest

from cinderlake.plans.medallion import load_latest
from cinderlake.schemas import INCIDENT_SCHEMA, REJECT_SCHEMA, REJECT_TABLE, names, struct
from cinderlake.sources.rejects import MALFORMED, MISSING, TooManyRejects, read_checked
from cinderlake.sources.snapshots import read_snapshot
from cinderlake.sources.warehouse import Warehouse

SCHEMA = struct("id long\nname string\nprice double\nwhen timestamp")


def put(tmp_path, *lines, name="s.csv", header="Id,Name,Price,When"):
    (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
    return str(tmp_path / name)


def faults(checked):
    found = checked.rejects.select("line", "column_name", "value", "reason").collect()
    return sorted(map(tuple, found), key=str)


def test_good_rows_and_every_fault(spark, tmp_path):
    path = put(
        tmp_path,
        "1,a,1.5,2024-01-06 00:00:00",
        "2,b,much,2024-02-30 00:00:00",
        "x3,c,NA,",
        "4,d",
        "5,e,1,2024-01-06 01:00:00,more",
        ",f,2,",
        '7,"g, ""h""",oops,',
    )
    checked = read_checked(spark, path, SCHEMA, required=["id"])
    assert [tuple(r) for r in checked.rows.collect()] == [(1, "a", 1.5, datetime(2024, 1, 6))]
    assert checked.rows.schema == SCHEMA and checked.rejects.schema == REJECT_SCHEMA
    assert checked.rejected_lines == 6
    assert faults(checked) == sorted(
        [
            ("2,b,much,2024-02-30 00:00:00", "price", "much", "not a double"),
            ("2,b,much,2024-02-30 00:00:00", "when", "2024-02-30 00:00:00", "not a timestamp_ntz"),
            ("x3,c,NA,", "id", "x3", "not a bigint"),
            ("4,d", None, None, MALFORMED),
            ("5,e,1,2024-01-06 01:00:00,more", None, None, MALFORMED),
            (",f,2,", "id", None, MISSING),
            ('7,"g, ""h""",oops,', "price", "oops", "not a double"),
        ],
        key=str,
    )
    assert {r.file.rsplit("/", 1)[1] for r in checked.rejects.collect()} == {"s.csv"}


def test_without_faults_it_reads_as_the_strict_reader(spark, tmp_path):
    path = put(tmp_path, "1,null,NaN,", "2, b ,-3e2,2024-01-06 12:30:00.5", '3,"",1,')
    checked = read_checked(spark, path, SCHEMA, most_rejects=0, required=["id"])
    assert checked.rejected_lines == 0 and checked.rejects.count() == 0
    assert checked.rows.collect() == read_snapshot(spark, path, SCHEMA).collect()
    kept = read_checked(spark, path, SCHEMA, na_tokens=())
    assert [r.name for r in kept.rows.collect()] == ["null", " b ", None]


def test_a_limit_stops_the_load(spark, tmp_path):
    path = put(tmp_path, *[f"{i},a,p{i}," for i in range(5)], "9,b,1,")
    with pytest.raises(TooManyRejects, match="5 bad lines where 4 are allowed"):
        read_checked(spark, path, SCHEMA, most_rejects=4)
    assert read_checked(spark, path, SCHEMA, most_rejects=5).rows.count() == 1


def test_wrong_columns_stay_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="missing columns"):
        read_checked(spark, put(tmp_path, "1,a,2", header="id,name,price"), SCHEMA)
    with pytest.raises(ValueError, match="unexpected columns"):
        read_checked(spark, put(tmp_path, "1,a,2,,3", header="id,name,price,when,what"), SCHEMA)
    with pytest.raises(ValueError, match="missing columns"):
        read_checked(spark, put(tmp_path, "1,a,2,,3", header="id,name,price,when,Name"), SCHEMA)
    with pytest.raises(ValueError, match="missing columns"):
        read_checked(spark, put(tmp_path, "1,a,2,"), SCHEMA, required=["nothing"])
    folder = tmp_path / "two"
    folder.mkdir()
    put(folder, "1,a,2,", name="a.csv")
    put(folder, "1,a,2,", name="b.csv", header="Id,Price,Name,When")
    with pytest.raises(Exception, match="header"):
        read_checked(spark, str(folder), SCHEMA).rows.collect()


def test_several_files_and_line_breaks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    put(folder, '1,"two\nlines",1,', name="a.csv")
    put(folder, '2,"two\nlines",bad,', "3,c,1,", name="b.csv")
    checked = read_checked(spark, str(folder), SCHEMA, multi_line=True)
    assert sorted(r.id for r in checked.rows.collect()) == [1, 3]
    assert [(r.file.rsplit("/", 1)[1], r.line) for r in checked.rejects.collect()] == [
        ("b.csv", '2,"two\nlines",bad,')
    ]


def incident(**given):
    return ",".join(str(given.get(n, "")) for n in names(INCIDENT_SCHEMA))


def test_load_with_rejects(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.reset()
    assert warehouse.read(REJECT_TABLE).count() == 0
    snapshots = tmp_path / "snapshots"
    snapshots.mkdir()
    put(
        snapshots, incident(id=1, battalion="B1"), incident(id="one", battalion="B2"),
        incident(battalion="B3"), "torn", incident(id=2, ems_units="x", city=3),
        header=",".join(names(INCIDENT_SCHEMA)),
    )
    with pytest.raises(TooManyRejects):
        load_latest(warehouse, str(snapshots), "first", most_rejects=3)
    assert warehouse.read("raw_fact_fire_department").count() == 0
    for _ in range(2):  # a load that is run again replaces its rejects
        gained = load_latest(warehouse, str(snapshots), "first", most_rejects=4)
    assert gained[REJECT_TABLE] == 4 and gained["raw_fact_fire_department"] == 1
    warehouse.register_views()
    found = spark.sql(f"SELECT column_name, reason, load_id FROM {REJECT_TABLE}").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("id", "not a bigint", "first"), ("id", MISSING, "first"), (None, MALFORMED, "first"),
         ("ems_units", "not a bigint", "first")], key=str,
    )
    assert [r.battalion for r in warehouse.read("dim_battalion").collect()] == ["B1"]
    with pytest.raises(Exception, match="does not fit|FAILFAST|alformed"):
        load_latest(warehouse, str(snapshots))

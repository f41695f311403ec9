import os
from datetime import datetime

import pytest
from pyspark.sql import Row

from cinderlake.schemas import INCIDENT_SCHEMA, names, struct
from cinderlake.sources.snapshots import (
    NA_TOKENS,
    latest_of_many,
    latest_snapshot,
    list_snapshots,
    next_snapshot_name,
    read_latest,
    read_snapshot,
    snapshot_files,
    write_snapshot,
)

SMALL = struct("id long\nname string\nat timestamp\nloss double")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def touch(path, text, moment):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    os.utime(path, (moment, moment))


def test_latest_is_the_last_modified_file_or_directory(spark, tmp_path):
    root = tmp_path / "a bucket"
    root.mkdir()
    assert latest_snapshot(spark, str(root)) is None
    touch(root / "z_old.csv", "id\n1\n", 1000)
    touch(root / "notes.txt", "x", 9000)
    touch(root / "dir_1.csv" / "part-0.csv", "id\n1\n", 500)
    touch(root / "dir_1.csv" / "part-1.csv", "id\n1\n", 1500)
    assert latest_snapshot(spark, str(root)) == "z_old.csv"  # the directory is not finished
    assert latest_snapshot(spark, str(root), unmarked=True) == "dir_1.csv"
    touch(root / "dir_1.csv" / "_SUCCESS", "", 2000)
    assert latest_snapshot(spark, str(root)) == "dir_1.csv"
    assert latest_snapshot(spark, f"file://{tmp_path}/a bucket/") == "dir_1.csv"
    touch(root / "c.csv", "id\n1\n", 2000)
    assert latest_snapshot(spark, str(root)) == "c.csv"
    touch(root / "sub" / "d.csv", "id\n1\n", 3000)
    touch(root / "sub" / "e.csv" / "f.csv", "id\n1\n", 2400)
    touch(root / "sub" / "e.csv" / "_SUCCESS", "", 2500)
    assert latest_snapshot(spark, str(root)) == "sub/d.csv"
    assert sorted(r.snapshot for r in list_snapshots(spark, str(root)).collect()) == [
        "c.csv",
        "dir_1.csv",
        "sub/d.csv",
        "sub/e.csv",
        "z_old.csv",
    ]
    with pytest.raises(ValueError, match="absolute"):
        list_snapshots(spark, "snapshots")


@pytest.mark.parametrize("name", ["plain", "a#b", "a?b", "a;b", "a[1]{2}*", "a b%20"])
def test_odd_folder_names_and_suffixes_in_capitals(spark, tmp_path, name):
    root = tmp_path / name
    touch(root / "City_Inc_1.csv", "id,name,at,loss\n1,a,,\n", 1000)
    touch(root / "more" / "Newer_Inc_2.CSV", "id,name,at,loss\n2,b,,\n", 2000)
    touch(tmp_path / "acb" / "Other_Inc_3.csv", "id,name,at,loss\n3,c,,\n", 3000)
    for given in (f"{root}", f"{tmp_path}//{name}/", f"{tmp_path}/./{name}"):
        assert latest_snapshot(spark, given) == "more/Newer_Inc_2.CSV"
        assert rows(read_latest(spark, given, SMALL).select("id")) == [(2,)]


@pytest.mark.parametrize(
    ("latest", "name"),
    [
        ("City_Incidents_20240106.csv", "City_Incidents_20240107_030405.csv"),
        ("City_Incidents_20240106_1_2.csv", "City_Incidents_20240107_030405.csv"),
        (None, "combined_data_20240107_030405.csv"),
        ("plain.csv", "combined_data_20240107_030405.csv"),
    ],
)
def test_next_snapshot_name(latest, name):
    assert next_snapshot_name(latest, datetime(2024, 1, 7, 3, 4, 5)) == name


def test_read_binds_by_normalised_name_and_types(spark, tmp_path):
    text = 'At,ID,Loss,NAME\n2024-01-06T10:00:00,3,1.5,"a ""b"", c"\n,4,NaN,None\n2024-01-06,,,\n'
    (tmp_path / "s.csv").write_text(text)
    read = read_snapshot(spark, str(tmp_path / "s.csv"), SMALL)
    assert read.schema == SMALL
    assert rows(read) == sorted(
        [
            (3, 'a "b", c', datetime(2024, 1, 6, 10), 1.5),
            (4, None, None, None),
            (None, None, datetime(2024, 1, 6), None),
        ],
        key=str,
    )
    kept = read_snapshot(spark, str(tmp_path / "s.csv"), SMALL, na_tokens=()).where("id = 4").first()
    assert kept.name == "None" and kept.loss != kept.loss


def test_every_token_reads_as_missing(spark, tmp_path):
    lines = "\n".join(f'{n},"{t}",,' for n, t in enumerate(NA_TOKENS))
    (tmp_path / "s.csv").write_text(f"id,name,at,loss\n{lines}\n99,na,,\n")
    read = read_snapshot(spark, str(tmp_path / "s.csv"), SMALL)
    assert read.where("name IS NULL").count() == len(NA_TOKENS)
    assert read.where("name = 'na'").count() == 1


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("id,name,at\n1,a,\n", "missing columns"),
        ("id,name,at,loss,more\n1,a,,,\n", "unexpected columns"),
        ("id,name,at,loss\n1.5x,a,,\n", "column id does not fit bigint: 1.5x"),
        ("id,name,at,loss\n1,a\n", "MALFORMED"),
        ('id,name,at,loss\n1,"a\nb",,\n', "MALFORMED"),
    ],
)
def test_read_fails_on_what_does_not_fit(spark, tmp_path, text, message):
    (tmp_path / "s.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read_snapshot(spark, str(tmp_path / "s.csv"), SMALL).collect()


def test_read_fails_without_ansi_too(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name,at,loss\n1.5x,a,,\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="column id does not fit bigint"):
            read_snapshot(spark, str(tmp_path / "s.csv"), SMALL).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_all_files_of_a_snapshot_have_the_same_header(spark, tmp_path):
    folder = tmp_path / "s.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("id,name,at,loss\n1,a,,\n")
    (folder / "part-1.csv").write_text("id,name,at,loss\n2,b,,\n")
    assert rows(read_snapshot(spark, str(folder), SMALL).select("id")) == [(1,), (2,)]
    (folder / "part-2.csv").write_text("name,id,at,loss\nc,3,,\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_snapshot(spark, str(folder), SMALL).collect()


def test_write_and_read_back_unchanged(spark, tmp_path):
    data = [
        (1, ' "quoted", \\ and\nbroken\r\nlines ', datetime(2024, 1, 6, 1, 2, 3, 456789), 0.1),
        (2, "\ttab ", None, 1e300),
        (3, None, datetime(1970, 1, 1), None),
        (4, "", None, -0.0),
    ]
    df = spark.createDataFrame(data, SMALL)
    path = write_snapshot(df, str(tmp_path), "a_b_c.csv")
    back = read_snapshot(spark, path, SMALL, na_tokens=(), multi_line=True)
    assert rows(back) == sorted(
        [r if r[1] != "" else (r[0], None, *r[2:]) for r in data], key=str
    )
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_snapshot(df, str(tmp_path), "a_b_c.csv")
    again = read_latest(spark, str(tmp_path), SMALL, na_tokens=(), multi_line=True)
    assert rows(again) == rows(back)


def test_no_snapshot_reads_as_empty(spark, tmp_path):
    empty = read_latest(spark, str(tmp_path))
    assert empty.schema == INCIDENT_SCHEMA and empty.count() == 0


def test_incident_schema():
    assert len(INCIDENT_SCHEMA) == len(set(names(INCIDENT_SCHEMA))) == 64
    assert Row(*names(INCIDENT_SCHEMA))[61] == "supervisor_district"


def test_latest_of_many_files(spark, tmp_path):
    """As the listing in the driver says, with folders enough to be listed in tasks."""
    assert latest_of_many(spark, str(tmp_path)) is None
    frame = spark.range(2).selectExpr("id AS a")
    for k in range(40):
        (tmp_path / f"year{k}").mkdir()
        (tmp_path / f"year{k}" / "s.csv").write_text("a\n1\n")
        os.utime(tmp_path / f"year{k}" / "s.csv", (1e9 + k, 1e9 + k))
    (tmp_path / "notes.txt").write_text("no snapshot")
    assert latest_of_many(spark, str(tmp_path)) == latest_snapshot(spark, str(tmp_path)) == "year39/s.csv"
    os.utime(tmp_path / "year3" / "s.csv", (1e9 + 39, 1e9 + 39))
    assert latest_of_many(spark, str(tmp_path)) == "year3/s.csv"  # the first by name among equals
    write_snapshot(frame, str(tmp_path), "deep/In_Parts.CSV")
    assert latest_of_many(spark, str(tmp_path)) == latest_snapshot(spark, str(tmp_path)) == "deep/In_Parts.CSV"
    for marker in (tmp_path / "deep" / "In_Parts.CSV").glob("*_SUCCESS*"):
        marker.unlink()
    assert latest_of_many(spark, str(tmp_path)) == "year3/s.csv"
    assert latest_of_many(spark, str(tmp_path), unmarked=True) == "deep/In_Parts.CSV"


def test_many_unfinished_snapshots(spark, tmp_path):
    (tmp_path / "old.csv").write_text("a\n1\n")
    os.utime(tmp_path / "old.csv", (1e9, 1e9))
    for k in range(45):
        (tmp_path / f"s{k}.csv").mkdir()
        (tmp_path / f"s{k}.csv" / "part-0.csv").write_text("a\n1\n")
    assert latest_of_many(spark, str(tmp_path)) == "old.csv"


def test_no_content_is_read_for_a_listing(spark, tmp_path, plan_text):
    (tmp_path / "a.csv").write_text("a\n1\n")
    plan = plan_text(snapshot_files(spark, str(tmp_path)))
    assert "content" not in plan.split("ReadSchema")[1]

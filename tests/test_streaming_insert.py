"""Insert-if-absent over a stream, started again and again."""

import pyarrow as pa
import pytest

from cinderlake.operators.keyed import insert_if_absent
from cinderlake.streaming import keyed
from cinderlake.streaming.keyed import ROCKS, STATE_STORE, _rank, insert_stream

SCHEMA = "k long, part string, v long, name string"


@pytest.fixture
def feed(spark, tmp_path):
    top = str(tmp_path)

    def run(rows=None, target=None, files=1):
        if rows is not None:
            spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{top}/in")
        query = insert_stream(stream, f"{top}/out", f"{top}/checkpoint", ["k", "part"], ["v"], target)
        query.awaitTermination()
        return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(f"{top}/out").collect()), key=str)

    return run


def test_equal_to_inserts_in_turn(spark, feed):
    first = [(i % 40, "a" if i % 2 else "b", -i, f"n{i}") for i in range(300)]
    second = [(i % 60, "a" if i % 3 else "b", i, f"m{i}") for i in range(300)] + [
        (None, "a", 1, "x"), (1, None, 1, "y"), (500, "a", None, "z"), (500, "a", 0, "zz")
    ]
    empty = spark.createDataFrame([], SCHEMA)
    held = insert_if_absent(empty, spark.createDataFrame(first, SCHEMA), ["k", "part"], ["v"], "drop")
    assert feed(first, files=5) == sorted(map(tuple, held.collect()), key=str)
    more = insert_if_absent(held, spark.createDataFrame(second, SCHEMA), ["k", "part"], ["v"], "drop")
    want = sorted(map(tuple, held.unionByName(more).collect()), key=str)
    assert feed(second, files=3) == want
    assert (500, "a", None, "z") in want
    # Starting again without anything new, or with the same rows, adds nothing.
    assert feed() == want and feed(second) == want
    assert spark.conf.get(STATE_STORE) != ROCKS


def test_keys_of_a_table_are_known_from_the_start(spark, feed):
    target = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "a")], "k long, part string")
    rows = [(1, "a", 1, "x"), (1, "b", 1, "x"), (2, "b", 1, "x"), (3, "a", 2, "later"), (3, "a", 1, "x")]
    want = [(1, "b", 1, "x"), (3, "a", 1, "x")]
    assert feed(rows, target) == want
    assert feed(rows, target) == want


def test_a_key_that_most_rows_have(spark, feed):
    rows = [(7 if i % 3 else i, "a", i, None) for i in range(3000)]
    got = feed(rows, files=4)
    assert len(got) == len({r[0] for r in rows})
    assert [r for r in got if r[0] == 7][0][2] == min(r[2] for r in rows if r[0] == 7)


def test_order_of_rows(spark):
    assert sorted([(2, "b"), (None, "z"), (2, None)], key=_rank) == [(None, "z"), (2, None), (2, "b")]


def test_state_takes_no_python_call_per_key(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1, "x")], SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    query = insert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["k", "part"], ["v"])
    query.awaitTermination()
    names = [o["operatorName"] for o in query.lastProgress["stateOperators"]]
    assert names == ["dedupe"]


def test_target_is_read_once(spark, feed):
    before = spark.createDataFrame([(1, "a")], "k long, part string")
    after = spark.createDataFrame([(1, "a"), (2, "a")], "k long, part string")
    assert feed([(1, "a", 1, "x")], before) == []
    assert feed([(1, "a", 0, "y"), (2, "a", 1, "x")], after) == [(2, "a", 1, "x")]
    assert feed([(1, "a", 0, "z"), (3, "a", 1, "x")]) == [(2, "a", 1, "x"), (3, "a", 1, "x")]


@pytest.mark.parametrize("size", [3, 1000])
def test_firsts_over_many_batches(size, monkeypatch):
    table = pa.table({"k": [i % 7 / 2 for i in range(500)], "v": [None if i == 430 else -i for i in range(500)]})
    table = pa.concat_tables([table, pa.table({"k": [float("nan")] * 2, "v": [9, 8]})])
    monkeypatch.setattr(keyed, "_GATHERED", 20)
    got = pa.Table.from_batches(keyed._reduced(iter(table.to_batches(max_chunksize=size)), ["k"], ["v"]))
    want = {k / 2: max(i for i in range(500) if i % 7 == k) * -1 for k in range(7)} | {430 % 7 / 2: None}
    assert {k: v for k, v in zip(*got.to_pydict().values()) if k == k} == want
    assert [v for k, v in zip(*got.to_pydict().values()) if k != k] == [8]


def test_order_of_nested_values():
    table = pa.table({"k": [1, 1, 2], "v": [[2], [1, 5], None]})
    assert keyed._firsts(table, ["k"], ["v"]).to_pydict() == {"k": [1, 2], "v": [[1, 5], None]}

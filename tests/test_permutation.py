"""Keys that are drawn without collisions, and functions for SQL."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cinderlake.functions.calendar import build_dim_date
from cinderlake.functions.draws import with_permutation
from cinderlake.functions.sql import register_functions
from cinderlake.functions.text import clean_str, first_letter_acronym
from cinderlake.plans.growth import new_incidents
from cinderlake.schemas import DIM_DATE_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources.synthetic import synthetic_incidents
from cinderlake.sources.warehouse import Warehouse

START, END = datetime(2020, 1, 1), datetime(2021, 1, 1)


def permuted(spark, count, seed=1, name="k", parts=3):
    frame = with_permutation(spark.range(0, count, 1, parts), "id", count, seed, [name])
    return {r["id"]: r[name] for r in frame.collect()}


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 6, 7, 8, 9, 31, 32, 33, 1000, 4095, 4096, 4097])
def test_one_to_one(spark, count):
    assert sorted(permuted(spark, count).values()) == list(range(count))


def test_it_depends_on_seed_name_and_row_alone(spark):
    one = permuted(spark, 500)
    assert one == permuted(spark, 500, parts=11)
    others = [permuted(spark, 500, seed=2), permuted(spark, 500, name="j")]
    for other in others:
        assert sum(one[k] == other[k] for k in one) < 20
    # Neighbours do not stay neighbours, and the first half goes everywhere.
    assert sum(abs(one[k] - one[k + 1]) == 1 for k in range(499)) < 20
    assert 80 < sum(one[k] < 250 for k in range(250)) < 170


def test_every_row_moves_in_turn(spark):
    places = [permuted(spark, 100, seed=s)[0] for s in range(8)]
    assert len(set(places)) > 4


def test_a_number_outside_is_an_error(spark):
    with pytest.raises(Exception, match="not between 0 and 4"):
        with_permutation(spark.range(6), "id", 5, 1, ["k"]).collect()


def test_no_hash_is_evaluated_twice(spark, plan_text):
    plan = plan_text(with_permutation(spark.range(1000), "id", 1000, 1, ["a", "b"]))
    assert plan.count("md5(") == 16 and "Exchange" not in plan


def test_incidents_with_distinct_keys(spark):
    rows = spark.range(400).toDF("row")
    maxima = {f: 1000 * n for n, f in enumerate(UNIQUE_FIELDS)}
    made = synthetic_incidents(rows, "row", 400, maxima, START, END, 5, distinct_keys=True)
    for f, top in maxima.items():
        assert sorted(r[f] for r in made.select(f).collect()) == list(range(top + 1, top + 401))
    # All else is drawn as without.
    drawn = synthetic_incidents(rows, "row", 400, maxima, START, END, 5)
    assert made.drop(*UNIQUE_FIELDS).exceptAll(drawn.drop(*UNIQUE_FIELDS)).count() == 0
    snapshot = made.drop("row").limit(100)
    assert new_incidents(snapshot, rows, "row", 400, START, END, 5, distinct_keys=True).count() == 400


def test_sql_functions_say_what_the_operators_say(spark):
    texts = [" ab　", "San  Francisco of the BAY", None, "", "\x85x\x1c", "O'Neill \\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    frame.createOrReplaceTempView("texts")
    register_functions(spark)
    register_functions(spark)  # again is fine
    got = spark.sql("SELECT clean_text(t), city_acronym(t) FROM texts").collect()
    want = frame.select(clean_str(F.col("t")), first_letter_acronym(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_a_warehouse_brings_the_functions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.reset()
    spark.sql("DROP TEMPORARY FUNCTION IF EXISTS clean_text")
    warehouse.register_views()
    assert spark.sql("SELECT clean_text(' a') AS a, count(*) AS n FROM dim_district").first() == ("A", 0)


def test_calendar_in_sql(spark):
    register_functions(spark)
    kinds = [(f.name, f.dataType.simpleString()) for f in DIM_DATE_SCHEMA.fields]
    assert spark.sql("SELECT * FROM calendar()").dtypes == kinds
    assert spark.sql("SELECT * FROM calendar()").exceptAll(build_dim_date(spark)).count() == 0
    some = spark.sql("SELECT * FROM calendar(DATE'2024-02-28', 3)")
    assert some.collect() == build_dim_date(spark, "2024-02-28", 3).collect()
    assert spark.sql("SELECT * FROM calendar(DATE'2024-02-28', 0)").count() == 0


def test_sql_functions_are_inlined(spark, plan_text):
    register_functions(spark)
    plan = plan_text(spark.sql("SELECT clean_text(string(id)) AS a, city_acronym(string(id)) AS b FROM range(5)"))
    assert "trim(upper(" in plan and "Python" not in plan and "clean_text" not in plan
    plan = plan_text(spark.sql("SELECT day_name FROM calendar(DATE'2024-01-01', 9)"))
    assert "Python" not in plan and "weekofyear" not in plan  # unused columns are not computed

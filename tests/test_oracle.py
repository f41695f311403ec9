"""Every query against the same result in SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from checks.compare import difference, oracle
from checks.oracle import ORACLE_SQL as ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="given tables not found")


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    assert entry_point.entry(spark).count() == 7


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == ""

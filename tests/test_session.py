"""The limit on compiled methods."""

from datetime import datetime

import pytest

from cinderlake.schemas import INCIDENT_SCHEMA, UNIQUE_FIELDS
from cinderlake.sources.snapshots import read_snapshot, write_snapshot
from cinderlake.sources.synthetic import synthetic_incidents
from cinderlake.workspace import empty_frame


@pytest.mark.parametrize("given, then", [("65535", "8000"), ("20000", "20000")])
def test_limit_on_methods_in_a_session_made_elsewhere(spark, tmp_path, given, then):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    for wide in (
        lambda: write_snapshot(empty_frame(spark, INCIDENT_SCHEMA), str(tmp_path), "a_b_1.csv"),
        lambda: read_snapshot(spark, f"{tmp_path}/a_b_1.csv"),
        lambda: synthetic_incidents(
            spark.range(1), "id", 1, dict.fromkeys(UNIQUE_FIELDS, 0), datetime(2020, 1, 1), datetime(2024, 1, 6)
        ),
    ):
        spark.conf.set(limit, given)
        try:
            wide()
            assert spark.conf.get(limit) == then
        finally:
            spark.conf.set(limit, before)

"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest
from check_queries import compare, connect

from __spark_entry__ import entry
from fieldmill.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert compare(spark, database, name, FOLDER) == ""


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["l_suppkey", "avgdelay", "avg_early_or_late"]
    assert frame.count() > 0

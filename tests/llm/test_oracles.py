from __future__ import annotations

import pytest
from check_queries import compare, connect

from fieldmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), name, folder) == ""


def test_queries_with_sql():
    assert sorted(queries.ORACLES) == [
        "op4_url_filter",
        "op5_embedding_near_dedup",
        "op7_decontaminate",
        "op9_substring_dedup",
    ]

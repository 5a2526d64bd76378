"""Registered queries with SQL against DuckDB; the others exist and run on whole tables."""

import pytest
from check_oracles import compare, connect

from __spark_entry__ import oracle_sql, queries
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert set(ORACLES) <= set(oracle_sql())

"""Every registered query against its SQL on DuckDB, on the smallest sample."""

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES.get(name)
    assert sql is not None, "every query has an oracle"
    assert compare(df, duck, sql) is None


def test_entry(spark):
    assert entry(spark).count() > 0

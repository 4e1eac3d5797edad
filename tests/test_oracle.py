"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from suite import REGISTRY
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) == ""


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "age_group",
        "product_id",
        "product_name",
        "total_quantity",
        "rank",
    ]
    assert not df.isEmpty()


def test_every_sql_has_a_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()

"""Every registered query against its SQL."""

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry_module
from tunewright.queries import all_queries, all_sql

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(all_queries()[name](spark, SMALL), con, all_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["conv_id", "part", "slice", "text", "split"]
    assert df.count() > 0

"""Every registered query against its SQL on the smallest test data."""

import pytest

from gridscope_checks import QUERIES, SQL
from gridscope_checks.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf, name):
    good, note = compare(spark, con, name, sf)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[-1] == "distance"
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""Every registered query of the analytics part against its SQL twin."""

import pytest

from millrace.plans import registry
from tests.oracle import connection, differs

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert differs(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_names_have_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0

import pytest

from millrace.plans import catalog

from .oracle import assert_same, views


@pytest.fixture(scope="module")
def con(small):
    return views(small)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, small, con, name):
    assert_same(catalog.QUERIES[name](spark, small), con, catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, small, name):
    df = catalog.QUERIES[name](spark, small)
    assert df.columns and df.count() >= 0


def test_entry(spark, small):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

import pytest
from conftest import DATA, same_rows

from glossweave.plans import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_agrees_with_sql(name, spark, duck):
    same_rows(registry.QUERIES[name](spark, DATA), duck.sql(registry.SQL[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_has_rows(name, spark):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

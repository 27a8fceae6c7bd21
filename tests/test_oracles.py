"""Every registered query with SQL gives exactly the rows DuckDB gives."""

import pytest

from compare import duck, duck_rows, spark_rows
from leadwright.plans import catalog


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, small, con, name):
    columns, rows = spark_rows(catalog.QUERIES[name](spark, small))
    want_columns, want = duck_rows(con, catalog.ORACLES[name])
    assert columns == want_columns
    assert rows == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_rows_only(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

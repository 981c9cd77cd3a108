"""Every registered query against its SQL in DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, folder, con, name):
    df = queries()[name](spark, folder)
    if name in SQL:
        problem, count = difference(df, con, SQL[name])
        assert problem is None
    else:
        count = df.count()
    assert count > 0 or name == "dq_inventory_conformance"


def test_entry(spark):
    assert entry(spark).count() > 0

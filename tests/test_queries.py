"""Every named query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, oracle_rows, spark_rows

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = connect(sf_dir)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = oracle_rows(con, SQL[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["merchant_id", "hour_bucket"]
    assert df.count() > 0

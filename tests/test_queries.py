"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, rows

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["KY_BA", "TASK_ID", "CALL_DATE", "CALL_START_TIME", "NumberOfCalls"]
    assert result.count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0

"""Every query with SQL: whole results equal on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf, duck):
    mine = QUERIES[name](spark, sf).toPandas()
    assert compare(mine, duck.execute(SQL[name]).df()) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "freq", "rank"] and df.count() > 0

"""Every registered query agrees with its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.compare import TABLES, rows_of

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["position", "label", "count", "percentage"] and df.count() == 3


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())

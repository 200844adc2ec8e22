"""Registered queries against their SQL on the smallest test tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
import __spark_entry__ as entry  # noqa: E402
from verify import TABLES, rows_of  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, data, con, name):
    df = entry.queries()[name](spark, data)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 1

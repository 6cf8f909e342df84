"""Every registered query against its oracle SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check_oracle import TABLES, as_rows, kinds

FOLDER = "/root/testdata/sf0.001"
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", spark_entry.queries())
def test_query(spark, duck, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    assert ours[1]
    if name not in SQL:
        pytest.skip("no SQL says the same")
    result = duck.execute(SQL[name])
    theirs = as_rows([d[0] for d in result.description], result.fetchall())
    assert ours == theirs
    assert kinds(ours[1]) == kinds(theirs[1])


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(SQL) <= set(spark_entry.queries())

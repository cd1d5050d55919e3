"""Every registered query against its SQL on the given tables."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(DATA).glob("*.parquet")):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    df = queries()[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql()[name]
    expected = duck.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    got, want = normal(rows, df.columns), normal(expected.fetchall(), expected.columns)
    assert len(got) == len(want)
    assert [g for g, w in zip(got, want) if g != w][:3] == [w for g, w in zip(got, want) if g != w][:3]


def test_entry(spark):
    assert entry(spark).count() > 0

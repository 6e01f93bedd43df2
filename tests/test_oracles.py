"""Every named query against its SQL on the smallest data set."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for table in TABLES.split():
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return con


def _rows(rows, order):
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    rows = df.collect()
    assert not any(isinstance(v, decimal.Decimal) for r in rows[:5] for v in r)
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    mine = _rows(rows, [df.columns.index(c) for c in columns])
    theirs = _rows(result.fetchall(), [names.index(c) for c in columns])
    assert mine == theirs

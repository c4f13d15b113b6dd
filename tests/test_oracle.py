"""Every query against its SQL in DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as contract
from changeloom.plans import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = {name: run for name, run in contract.queries().items() if name in all_queries()[0]}
ORACLES = all_queries()[1]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(round(float(value), 9)) if abs(value) < 1e6 else str(value)
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0

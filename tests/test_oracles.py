"""Registered queries against their SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.plans import catalogue

from .conftest import DATA

SF = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.iterdir():
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6g}"
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(SF))
    got = duck.execute(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(d[0] for d in got.description)
    assert rows(df.columns, df.collect()) == rows([d[0] for d in got.description], got.fetchall())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

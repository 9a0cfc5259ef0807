"""Every query with an SQL equivalent gives the same rows as DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from statspark import catalog, fixtures


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in (*fixtures.TABLES, "documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value.isoformat()[:19] if hasattr(value, "isoformat") else value


def same_rows(df, con, sql):
    names = sorted(df.columns)
    want = con.sql(sql)
    assert sorted(want.columns) == names
    got = sorted(repr([plain(x) for x in row]) for row in df.select(names).collect())
    assert got == sorted(repr([plain(x) for x in row]) for row in want.select(*(f'"{n}"' for n in names)).fetchall())
    return len(got)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    n = same_rows(catalog.queries()[name](spark, sf_dir), duck, catalog.oracle_sql()[name])
    assert (n == 0) == (name == "predictions_none_scheduled")


def test_entry(spark):
    assert {"player_id", "as_of_date", "bat_woba"} <= set(entry.entry(spark).columns)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

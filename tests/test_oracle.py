"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bartide.operators import options

SQL = entry.oracle_sql()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        c.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())


def test_union_has_every_row(spark, sf, db):
    n = db.execute("select (select count(*) from candle) + (select count(*) from candle_batch)").fetchone()[0]
    df = entry.queries()["union_by_name"](spark, sf)
    assert df.count() == n and df.where("id is null").count() == 0


def test_mark_without_ticker(spark):
    marks = spark.createDataFrame([(k, f"BTC-260101-{k}-C", 1.0) for k in (1, 2)], "id long, symbol string, price double")
    tickers = spark.createDataFrame([("BTC-260101-1-C", 5.0, 1), ("BTC-260101-1-C", 6.0, 2)], "symbol string, price double, id long")
    spots = spark.createDataFrame([("BTC", 9.0)], "underlying string, spot double")
    out = options.snapshot(marks, tickers, spots, "id", 2, F.lit("2025-01-01").cast("date"))
    assert sorted((r.mark_id, r.ticker_price, r.spot) for r in out.collect()) == [(1, 6.0, 9.0), (2, None, 9.0)]

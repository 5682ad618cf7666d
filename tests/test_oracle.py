"""Every registered query against its DuckDB oracle, on the sf0.001 tables."""

import collections
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from ticklake.plans.catalog import QUERIES
from ticklake.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
TABLES = "events documents pages conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return round(v, 9)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    want_cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want) > 0
    assert _bag(df.columns, got) == _bag(want_cols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "symbol", "avg_price", "stddev_price", "total_volume", "trade_count"]


@pytest.mark.parametrize(
    "name",
    ["envelope_from_frames", "silver_agg_trade", "silver_book_ticker", "silver_depth10", "gold_spread", "kafka_round_trip"],
)
def test_query_matches_oracle_with_ansi_off_and_case_sensitive(spark, duck, name):
    old = (spark.conf.get("spark.sql.ansi.enabled"), spark.conf.get("spark.sql.caseSensitive"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = entry.queries()[name](spark, SF)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old[0])
        spark.conf.set("spark.sql.caseSensitive", old[1])
    res = duck.execute(entry.oracle_sql()[name])
    want_cols = [c[0] for c in res.description]
    assert _bag(df.columns, got) == _bag(want_cols, res.fetchall())

"""Registered queries against their DuckDB oracle SQL on sf0.001 (fast subset)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

FAST = ["r07", "r16", "r17", "r18", "r19", "r21", "r22", "r23", "r27", "r29", "r30", "r31", "r34", "r35", "r36",
        "r39", "r41", "r45", "r46", "r47", "r50", "r52", "r74", "r40b", "r61b", "r64b", "r73b", "r75b"]
TABLES = ["region", "nation", "orders", "events"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("prefix", FAST)
def test_matches_oracle(spark, sf, con, prefix):
    qs, sql = E.queries(), E.oracle_sql()
    names = [n for n in qs if n.startswith(prefix + "_")]
    assert names
    for name in names:
        got = _rows(qs[name](spark, sf).toPandas())
        want = _rows(con.execute(sql[name]).df())
        assert got == want, name


def test_every_query_has_a_callable_and_sql_keys_are_known():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "planes_30min" in df.columns

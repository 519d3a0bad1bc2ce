"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check, smaller)."""

from __future__ import annotations

import datetime as dt
import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.sources.tables import TABLES

SF = os.environ.get("TIDEMARK_ORACLE_SF", "/root/testdata/sf0.001")  # set to sf0.01 for the driver's scale


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(srows, sdf.columns) == _canon(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "Id"

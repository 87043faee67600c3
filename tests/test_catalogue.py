"""Every query against its SQL, on the smallest tables."""

import datetime as dt
import decimal
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__
from causeway.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (pd.Timestamp, dt.datetime, dt.date)):
        return str(pd.Timestamp(v))
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number, decimal.Decimal)):
        return round(float(v), 5)
    return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES.split():
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = catalogue.QUERIES[name](spark, sf).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or isinstance(p, float) and isinstance(q, float) and abs(p - q) < 2e-5 for p, q in zip(x, y)), (x, y)


def test_points_on_edges_equal_sql(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"copy (select unnest([5116, 187906])::bigint as c_custkey) to '{tmp_path}/customer.parquet' (format parquet)")
    con.execute(f"create view customer as select * from '{tmp_path}/customer.parquet'")
    got, want = catalogue.QUERIES["point_in_zone"](spark, str(tmp_path)).toPandas(), con.execute(catalogue.ORACLES["point_in_zone"]).df()
    assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

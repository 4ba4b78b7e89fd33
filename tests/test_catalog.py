"""Every catalog query against DuckDB on the smallest tables."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from claimgraph.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
        return "~"
    if isinstance(x, bool | np.bool_):
        return str(bool(x))
    if isinstance(x, float | np.floating):
        return f"{x:.6g}"
    return str(x)


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        whole = df[c].dtype.kind == "f" and (df[c].dropna() % 1 == 0).all()
        df[c] = df[c].astype("Int64" if whole else object).astype(object).map(plain)
    return sorted(map(tuple, df.itertuples(index=False)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)

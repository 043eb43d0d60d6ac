"""Every catalog query with an oracle, against DuckDB on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from textveil.plans import catalog, oracles

DATA = os.environ.get("TEXTVEIL_DATA", "/root/testdata/sf0.001")
ORACLES = oracles.oracle_sql()


def rows(df):
    cols = sorted(df.columns)
    show = lambda v: None if pd.isna(v) else round(float(v), 9) if not isinstance(v, (str, bool)) else v
    return sorted((tuple(show(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    mine, theirs = catalog.Q[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)

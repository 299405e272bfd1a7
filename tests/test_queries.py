"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

from confluo import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return round(v, 9)
        return int(v) if hasattr(v, "__index__") else v

    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ours, theirs = registry.queries()[name](spark, DATA).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_flagship(spark):
    clusters = registry.flagship(spark, DATA).toPandas()
    assert clusters.n_members.sum() == spark.read.parquet(f"{DATA}/documents.parquet").count()

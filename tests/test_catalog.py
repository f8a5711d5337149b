"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from viewloom.plans import catalog, more, scenes  # noqa: F401
from viewloom.plans.base import TABLES

SF = "/root/testdata/sf0.001"


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple("~" if pd.isna(v) else f"{v:.7g}" if isinstance(v, float) else str(v) for v in r) for r in df[columns].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    found = rows(catalog.QUERIES[name](spark, SF).toPandas())
    if name in catalog.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        assert found == rows(con.sql(catalog.ORACLES[name]).df())


def test_entry(spark):
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())

"""Every registered query with SQL against DuckDB on the smallest scale."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from corvidex import plans

DATA = "/root/testdata/sf0.001"


def rows(df):
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return f"{float(v):.5f}" if isinstance(v, (int, float)) or getattr(getattr(v, "dtype", None), "kind", "") in "iuf" and hasattr(v, "dtype") else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    got = plans.QUERIES[name](spark, DATA).toPandas()
    if name in plans.SQL:
        assert rows(got) == rows(duck.execute(plans.SQL[name]).df())
    else:
        assert len(got)

"""Every registered query runs, and gives what its SQL gives in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from gridloom.plans.meter_queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
#: These take longest; the driver runs them.
SLOW = {"i7_interval_coverage", "p2_train_forecast", "e2_linear_backtest", "e3_pooled_backtest", "e4_cross_validate", "e12_benchmark", "m3_gbt_pooled", "m4_tweedie", "m4_grouped_tweedie", "m5_quantile_forest", "e3_forest_backtest"}


def rows(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        kind = str(df[c].dtype)
        if kind.startswith("datetime"):
            out[c] = df[c].astype("datetime64[us]").astype(str)
        else:
            real = "float" in kind.lower()
            out[c] = df[c].astype(object).map(lambda v, real=real: "-" if pd.isna(v) else f"{v:.4f}" if real else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLE_SQL:
        want = rows(duck.sql(ORACLE_SQL[name]).df())
        got = rows(got)
        assert list(got.columns) == list(want.columns)
        pd.testing.assert_frame_equal(got, want, check_dtype=False)

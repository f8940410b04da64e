"""Models on packed rows, and quantiles of counted values, give what the rows one by one give."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import models as M
from gridloom.operators import packed as P


def test_grouped_tweedie_on_packed_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(f"d{i % 2}", i, rnd.choice((0.0, 1.0)) * rnd.random() * 4, rnd.random(), [1, 2, 3], [rnd.random(), None, rnd.random()], [rnd.random(), None, rnd.random()]) for i in range(200)]
    pack = spark.createDataFrame(rows, "device_id string, ts_hour int, y double, x double, _h array<int>, _m array<double>, _s array<double>")
    plain = P.unpacked(pack, "y")

    def store(df, n=[0]):  # noqa: B006
        n[0] += 1
        df.write.parquet(f"{tmp_path}/{n[0]}")
        return spark.read.parquet(f"{tmp_path}/{n[0]}")

    tweedie = M.GroupedTweedie("y", ["x", "y_roll_24h_mean", "y_roll_24h_std", "horizon"], ["device_id"], rounds=4, ridge=1e-3, store=store)
    want, got = ({r.device_id: r.coefficients for r in tweedie.fit(m).collect()} for m in (plain, pack))
    assert want.keys() == got.keys() == {"d0", "d1"}
    assert all(np.allclose(want[k], got[k]) for k in want)


def test_leaf_quantiles_are_those_of_all_rows(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.random(), float(rnd.randint(0, 9))) for _ in range(300)], "x double, y double")
    told = M.quantile_leaf(df, df, "y", ["x"], depth=2)
    assert "percentile(_v" in told._jdf.queryExecution().analyzed().toString()
    rows = told.collect()
    by: dict = {}
    for r in rows:
        by.setdefault((r.q_low, r.q_high), []).append(r.y)
    leaves = [k for k, v in by.items() if (pytest.approx(np.quantile(v, 0.25)), pytest.approx(np.quantile(v, 0.75))) == k]
    assert len(leaves) == len(by) and told.where(F.col("q_low").isNull()).count() == 0

"""The registered training and evaluation queries take all horizons, origins and features of their operators."""

from __future__ import annotations

import datetime as dt

import pytest

from gridloom.operators import evaluation as E
from gridloom.operators import features as X
from gridloom.operators import models as M
from gridloom.plans.base import CFG
from gridloom.plans.meter_queries import QUERIES

TRAINED = ("m2_grouped_linear", "m3_gbt_pooled", "m4_tweedie", "m5_quantile_leaf", "m9_warm_start", "r3_saved_model", "t3_stream_model_update", "e2_linear_backtest", "e3_pooled_backtest", "e4_cross_validate", "e12_benchmark", "i6_interval_backtest", "i7_interval_coverage")


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", TRAINED)
def test_all_horizons(spark, sf_dir, monkeypatch, name):
    def matrix(df, target, horizons, *rest, **more):
        raise Asked(list(horizons))

    monkeypatch.setattr(X, "training_matrix", matrix)
    with pytest.raises(Asked) as asked:
        QUERIES[name](spark, sf_dir)
    assert asked.value.args[0] == list(range(1, CFG.horizon + 1))


@pytest.mark.parametrize("name", ["m2_grouped_linear", "m3_gbt_pooled", "m4_tweedie", "m5_quantile_leaf", "m9_warm_start", "r3_saved_model"])
def test_all_features(spark, sf_dir, monkeypatch, name):
    def model(self, target, features, *rest, **more):
        raise Asked(list(features), more)

    for kind in (M.GroupedLinear, M.GbtPooled, M.TweedieImport):
        monkeypatch.setattr(kind, "__init__", model)
    monkeypatch.setattr(M, "quantile_leaf", lambda train, *rest, **more: model(train, *rest[1:], **more))
    with pytest.raises(Asked) as asked:
        QUERIES[name](spark, sf_dir)
    assert set(asked.value.args[0]) == {*CFG.calendar, *(f"grid_import_{lag}" for lag in CFG.lags), "horizon"}
    assert set(asked.value.args[1]) <= {"validation"}


def test_benchmark_takes_all_origins(spark, sf_dir, monkeypatch):
    def origins(df, cfg, n=None):
        raise Asked(n or cfg.backtest_origins)

    monkeypatch.setattr(E, "backtest_origins", origins)
    with pytest.raises(Asked) as asked:
        QUERIES["e12_benchmark"](spark, sf_dir)
    assert asked.value.args[0] == CFG.backtest_origins == 21


def test_every_band_has_a_model(spark, sf_dir):
    assert {r.band for r in QUERIES["m2_grouped_linear"](spark, sf_dir).where("mae is not null").select("band").distinct().collect()} == {"short", "medium", "long"}


def test_lags_of_all_horizons_by_brute_force(spark):
    start = dt.datetime(2025, 1, 1)
    value = {start + dt.timedelta(hours=i): float((i * 37) % 101) for i in range(16 * 24) if i % 29}
    df = spark.createDataFrame([("d", t, v) for t, v in value.items()], "device_id string, ts_hour timestamp, grid_import double")
    got = X.train_lags(df, "grid_import", range(1, 49)).collect()
    assert len(got) == 48 * len(value)
    for r in got:
        day = [value.get(r.ts_hour - dt.timedelta(days=k)) for k in range(15)]
        first = day[2] if r.horizon > 24 else day[1]
        week = [v for v in day[2 if r.horizon > 24 else 1 : 8] if v is not None]
        trail = [v for i in range(24) if (v := value.get(r.ts_hour - dt.timedelta(hours=r.horizon + i))) is not None]
        known = r.ts_hour - dt.timedelta(hours=r.horizon) in value and len(trail) >= 12
        assert (r.grid_import_same_hour_1d, r.grid_import_same_hour_7d, r.grid_import_same_hour_14d) == (first, day[7], day[14])
        assert r.grid_import_mean_same_hour_7d == (pytest.approx(sum(week) / len(week)) if week else None)
        assert r.grid_import_roll_24h_mean == (pytest.approx(sum(trail) / len(trail)) if known else None)

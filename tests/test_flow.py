"""The daily run: full, warm, and the same again; the log, drift, and scoring from what was saved."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import flow as W
from gridloom.operators import records as R
from gridloom.schema import SchemaError
from gridloom.sources import versions

#: No outliers: whether an hour is one depends on the days around it, so a refit may leave out rows that an earlier run took.
CFG = Config(min_span_days=14.0, cv_folds=1, outlier_zscore=1e9)
DAYS = [dt.datetime(2025, 2, d, 12, tzinfo=dt.timezone.utc) for d in (24, 26)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("stored")

    def write(df):
        path = str(where / f"t{len(list(where.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="module")
def runs(spark, raw_meters, store, tmp_path_factory):
    """A full run without dev-B, then a warm one with it, then that one again."""
    root = str(tmp_path_factory.mktemp("root"))
    seen = lambda day: raw_meters.where(F.col("ts") < F.lit(day))
    done = [W.daily_run(seen(DAYS[0]).where("device_id = 'dev-A'"), CFG, root, DAYS[0], store=store)]
    first = {k: done[0][k].collect() for k in ("models", "metrics", "drift")}
    done.append(W.daily_run(seen(DAYS[1]), CFG, root, DAYS[1], store=store))
    second = {k: done[1][k].collect() for k in ("models", "metrics", "drift", "forecasts")}
    again = W.daily_run(seen(DAYS[1]), CFG, root, DAYS[1], store=store)
    third = {k: again[k].collect() for k in ("models", "metrics", "drift", "forecasts")}
    return root, first, second, third, seen(DAYS[1])


def test_runs_are_logged(spark, runs):
    root, first, second, _, _ = runs
    log = {(r.device_id, r.session): r.kind for r in spark.read.parquet(f"{root}/runs").collect()}
    assert log == {("dev-A", "20250224T120000"): "full", ("dev-A", "20250226T120000"): "warm", ("dev-B", "20250226T120000"): "warm"}
    assert {r.key for r in first["metrics"]} >= {"cv_mae_grid_import", "naive_mae_grid_import", "train_mae_grid_import"} and first["drift"] == []
    assert {r.key for r in second["metrics"]} == {"train_mae_grid_import", "train_mae_grid_export"}
    before = {r.key: r.value for r in first["metrics"]}
    assert {r.device_id for r in second["drift"]} == {"dev-A"}
    for r in second["drift"]:
        assert r.previous == before[r.key] and r.change == pytest.approx(r.current / r.previous - 1) and r.degraded == (r.change > 0.15)


def test_the_same_run_again_changes_nothing(spark, runs):
    root, _, second, third, _ = runs
    key = lambda rows: sorted(map(str, rows))
    assert all(key(second[k]) == key(third[k]) for k in ("models", "metrics", "drift", "forecasts"))
    assert versions.versions(spark, f"{root}/models") == [int(DAYS[1].timestamp())] and spark.read.parquet(f"{root}/runs").count() == 3


def test_a_warm_model_is_a_refitted_one(spark, runs, store, tmp_path_factory):
    """The point model is that of all rows; bounds are those of the last full fit; a new device is fitted in full."""
    _, first, second, _, meters = runs
    full = W.daily_run(meters, CFG, str(tmp_path_factory.mktemp("full")), DAYS[1], full=True, store=store)
    want = {(r.device_id, r.target, r.band): r for r in full["models"].collect()}
    got = {(r.device_id, r.target, r.band): r for r in second["models"]}
    old = {(r.device_id, r.target, r.band): r for r in first["models"]}
    assert set(got) == set(want) and {k[0] for k in got} == {"dev-A", "dev-B"}
    for k, r in got.items():
        assert np.allclose(r.point, want[k].point, rtol=1e-4, atol=1e-6)
        kept = old.get(k, want[k])
        assert r.threshold == pytest.approx(kept.threshold) and np.allclose(r.half, kept.half)


def test_scores_come_from_the_saved_models(runs, store):
    root, _, second, _, meters = runs
    told = {(r.device_id, r.horizon): r for r in W.score_saved(meters, CFG, root, store=store).collect()}
    want = {(r.device_id, r.target, r.horizon): r for r in second["forecasts"]}
    assert len(told) == 96
    for (device, horizon), r in told.items():
        assert r.grid_import_kwh == pytest.approx(want[device, "grid_import", horizon].prediction, abs=6e-4)
        if (device, "grid_export", horizon) not in want:
            assert r.grid_export_kwh == 0  # dev-B's gate is shut
        else:
            assert r.grid_import_lower == pytest.approx(want[device, "grid_import", horizon].prediction_lower, abs=6e-4)
    with pytest.raises(SchemaError):
        W.score_saved(meters, CFG, root + "/nothing", store=store)


def test_gates_in_batch_scores(raw_meters):
    """A backend that tells 1 for everything: shut targets are 0."""
    ones = lambda history, origins, target: R.forecast_origins(history).select("device_id", F.lit(target).alias("target"), "origin", (F.col("origin") + F.make_dt_interval(hours=F.lit(1))).alias("ts_hour"), F.lit(1).alias("horizon"), F.lit(1.0).alias("prediction"))
    got = {r.device_id: (r.grid_export_kwh, r.grid_import_kwh) for r in R.batch_score(raw_meters, CFG, ones, gated=True).collect()}
    assert got == {"dev-A": (1.0, 1.0), "dev-B": (0.0, 1.0)}
    assert {r.grid_export_kwh for r in R.batch_score(raw_meters, CFG, ones).collect()} == {1.0}

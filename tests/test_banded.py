"""Models as of past moments, intervals, and the flow from readings to records."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import banded as N
from gridloom.operators import cleaning as C
from gridloom.operators import evaluation as E
from gridloom.operators import models as M
from gridloom.operators import records as R
from gridloom.schema import SchemaError
from gridloom.sources.sinks import load_model, save_model

CFG = Config(min_span_days=14.0)
START = dt.datetime(2025, 3, 1)


def test_models_as_of_by_brute_force(spark):
    """Also at a moment in a gap, and at moments that only other devices have rows at."""
    rnd = np.random.default_rng(3)
    rows = [(d, b, START + dt.timedelta(hours=i), float(rnd.normal()), float(rnd.normal())) for d in ("a", "b") for b in ("short", "medium", "long") for i in range(60) if d == "b" or not 30 <= i <= 45]
    matrix = spark.createDataFrame(rows, "device_id string, band string, ts_hour timestamp, y double, x double")
    moments = [("a", 20), ("a", 40), ("b", 31), ("b", 59)]
    asked = spark.createDataFrame([(d, START + dt.timedelta(hours=h)) for d, h in moments], "device_id string, at timestamp")
    linear = M.GroupedLinear("y", ["x"], ["device_id", "band"], ridge=0.0)
    got = {(r.device_id, r.band, r["at"]): r.coefficients for r in E.models_as_of(linear, matrix, asked, CFG).collect()}
    assert len(got) == 4 * 3
    for d, h in moments:
        for b in ("short", "medium", "long"):
            at = START + dt.timedelta(hours=h)
            past = np.array([r[3:] for r in rows if r[0] == d and r[1] == b and r[2] <= at])
            slope, intercept = np.polyfit(past[:, 1], past[:, 0], 1)
            assert got[d, b, at] == pytest.approx([intercept, slope])
    assert E.models_as_of(linear, matrix, asked, CFG, min_rows=1000).isEmpty()


@pytest.fixture(scope="module")
def flow(spark, raw_meters, tmp_path_factory):
    where = tmp_path_factory.mktemp("flow")

    def store(df):
        path = str(where / f"t{len(list(where.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return N.train_forecast(raw_meters, CFG, cv=False, store=store), store, str(where)


def test_flow(spark, raw_meters, flow):
    done, store, where = flow
    assert {r.device_id: r.eligible for r in done["eligibility"].collect()} == {"dev-A": True, "dev-B": True}
    pairs = {(r.device_id, r.target) for r in done["forecasts"].select("device_id", "target").distinct().collect()}
    assert pairs == {("dev-A", "grid_export"), ("dev-A", "grid_import"), ("dev-B", "grid_import")}  # dev-B exports nothing
    rows = done["forecasts"].collect()
    assert len(rows) == 3 * 48
    assert all(0 <= r.prediction_lower <= r.prediction <= r.prediction_upper for r in rows)
    assert any(r.prediction_lower < r.prediction_upper for r in rows)
    records = {r.device_id: r.forecasts for r in done["records"].collect()}
    assert [h.horizon for h in records["dev-A"]] == list(range(1, 49))
    assert all(h.grid_import_upper is not None for h in records["dev-A"])
    assert all(h.grid_import_upper is None for h in records["dev-B"])  # bounds need both targets

    # a saved model scores the same readings the same way
    save_model({"models": done["models"]}, f"{where}/model")
    models = load_model(spark, f"{where}/model")[0]["models"]
    flat = {(r.device_id, r.horizon): r for r in R.batch_score(raw_meters, CFG, N.fitted_backend(N.BandedLinear(CFG), models)).collect()}
    for h in records["dev-A"]:
        again = flat["dev-A", h.horizon]
        assert (again.grid_export_kwh, again.grid_import_kwh, again.grid_export_lower, again.grid_import_upper) == (h.grid_export_kwh, h.grid_import_kwh, h.grid_export_lower, h.grid_import_upper)


def test_bounds_cover_and_do_not_look_ahead(spark, raw_meters, flow):
    _, store, _ = flow
    one = replace(CFG, targets=("grid_import",))
    hourly = store(C.processed_hourly(raw_meters, one))
    backend = N.interval_backend(N.BandedLinear(one, store=store))
    origins = E.backtest_origins(hourly, one, 5)
    rows = store(E.run_backtest(hourly, one, backend, n_origins=5))
    inside = rows.agg(F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0]
    assert 0.3 < inside < 0.8  # cqr_coverage is 0.5
    first = origins.groupBy("device_id").agg(F.min("origin").alias("origin"))
    changed = hourly.join(first.withColumnRenamed("origin", "_o"), "device_id").withColumn("grid_import", F.when(F.col("ts_hour") > F.col("_o"), F.lit(99.0)).otherwise(F.col("grid_import"))).drop("_o")
    key = lambda df: sorted((r.device_id, r.horizon, round(r.prediction, 9), round(r.lower, 9), round(r.upper, 9)) for r in df.collect())
    assert key(backend(hourly, first, "grid_import")) == key(backend(store(changed), first, "grid_import"))


def test_imports_by_a_log_link(spark, raw_meters, flow):
    """Every import model has a log link, exports keep theirs; bounds hold, saved models tell the same, and zeros have no log link."""
    _, store, _ = flow
    done = N.train_forecast(raw_meters, CFG, cv=False, store=store, import_link="log")
    assert {(r.target, r.link) for r in done["models"].select("target", "link").collect()} == {("grid_export", "identity"), ("grid_import", "log")}
    rows = {(r.device_id, r.target, r.horizon): r for r in done["forecasts"].collect()}
    assert len(rows) == 3 * 48 and all(0 <= r.prediction_lower <= r.prediction <= r.prediction_upper for r in rows.values())
    mean = raw_meters.agg(F.avg("consumption_kwh")).first()[0] * 4
    assert np.mean([r.prediction for k, r in rows.items() if k[1] == "grid_import"]) == pytest.approx(mean, rel=0.2)
    told = R.batch_score(raw_meters, CFG, N.fitted_backend(N.BandedLinear(CFG), done["models"])).collect()
    assert all(r.grid_import_kwh == pytest.approx(rows[r.device_id, "grid_import", r.horizon].prediction, abs=6e-4) for r in told)
    with pytest.raises(ValueError):
        hourly = store(C.processed_hourly(raw_meters, CFG))
        N.BandedLinear(CFG, store=store, link="log").fit(hourly, E.backtest_origins(hourly, CFG, 2), "grid_import")


def test_nobody_has_enough(raw_meters):
    with pytest.raises(SchemaError):
        N.train_forecast(raw_meters, replace(CFG, min_span_days=300.0), cv=False)

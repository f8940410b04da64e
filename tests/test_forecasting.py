from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import cleaning as C
from gridloom.operators import evaluation as E
from gridloom.operators import features as X
from gridloom.operators import intervals as I
from gridloom.operators import joins as J
from gridloom.operators import models as M
from gridloom.operators import records as R
from gridloom.operators import runlog as L
from gridloom.operators import summaries as A

CFG = Config(min_span_days=14)
T0 = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def series(spark, values, device="d", start=T0):
    rows = [(device, start + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "device_id string, ts_hour timestamp, grid_import double")


@pytest.fixture(scope="module")
def hourly(spark, raw_meters):
    df = C.processed_hourly(raw_meters, CFG).cache()
    yield df
    df.unpersist()


def test_naive_repeats_the_week_and_never_looks_ahead(spark):
    df = series(spark, [i % 24 for i in range(21 * 24)])
    origin = T0 + dt.timedelta(hours=21 * 24 - 1)
    origins = spark.createDataFrame([("d", origin)], "device_id string, origin timestamp")
    rows = M.naive_forecast(df, origins, "grid_import", CFG).orderBy("horizon").collect()
    assert [r.prediction for r in rows] == [float(h % 24) for h in range(48)]
    short = M.naive_forecast(df, origins, "grid_import", CFG, 24).orderBy("horizon").collect()
    assert all(r.prediction is None for r in short[24:])


def test_naive_zero_for_missing_value_null_for_missing_row(spark):
    df = series(spark, [None, 5.0]).where("ts_hour < '2025-01-01 02:00'")
    origins = spark.createDataFrame([("d", T0 + dt.timedelta(hours=167))], "device_id string, origin timestamp")
    got = {r.horizon: r.prediction for r in M.naive_forecast(df, origins, "grid_import", CFG).collect()}
    assert got[1] == 0.0 and got[2] == 5.0 and got[3] is None


def test_lags_by_time(spark):
    df = series(spark, range(400)).where("hour(ts_hour) <> 5")
    out = X.train_lags(df, "grid_import", [6, 36]).where("ts_hour = '2025-01-16 06:00'").orderBy("horizon").collect()
    n = 15 * 24 + 6
    assert [r.grid_import_same_hour_1d for r in out] == [n - 24, n - 48]
    assert out[0].grid_import_mean_same_hour_7d == pytest.approx(n - 4 * 24) and out[1].grid_import_mean_same_hour_7d == pytest.approx(n - 4.5 * 24)
    assert X.train_lags(df, "grid_import", [36], parity=True).where("ts_hour = '2025-01-16 06:00'").first().grid_import_mean_same_hour_7d == pytest.approx(n - 4 * 24)


def test_features_of_forecast_equal_those_of_training(spark, hourly):
    """What a model is fitted on is what it is given later."""
    origins = E.backtest_origins(hourly, CFG)
    fc = X.forecast_matrix(hourly, origins, "grid_import", CFG)
    train = X.training_matrix(hourly, "grid_import", [6, 36], CFG).withColumn("origin", F.expr("ts_hour - make_dt_interval(0, horizon)"))
    names = [c for c in fc.columns if c.startswith("grid_import_")]
    both = train.alias("t").join(fc.alias("f"), ["device_id", "origin", "ts_hour", "horizon"])
    apart = [F.max(F.abs(F.coalesce(F.col(f"t.{n}"), F.lit(0.0)) - F.coalesce(F.col(f"f.{n}"), F.lit(0.0)))).alias(n) for n in names]
    row = both.agg(F.count(F.lit(1)).alias("n"), *apart).first()
    assert row.n > 0 and all(row[n] < 1e-9 for n in names)


def test_split_truncates(spark):
    got = {r.split: r["count"] for r in X.split_70_15_15(series(spark, range(97))).groupBy("split").count().collect()}
    assert got == {"train": 67, "valid": 15, "test": 15}


def test_scaler_is_blind_to_the_band(spark):
    plain, changed = [1.0] * 70 + [2.0] * 30, [1.0] * 70 + [99.0] * 30
    a, b = (X.pool_state(series(spark, v), "grid_import", 10, 10)[0].first() for v in (plain, changed))
    assert (a.log_mean, a.log_std) == (b.log_mean, b.log_std) == (pytest.approx(np.log(2)), 1.0)
    dropped = X.pool_state(series(spark, range(5)), "grid_import", 10, 10)[2].first()
    assert dropped.reason == "too few rows"


def test_scaling_round_trip(spark):
    df = series(spark, range(50))
    scalers = X.fit_log_scaler(df, "grid_import")
    back = X.inverse_log_standardize(X.log_standardize(df, scalers, "grid_import"), scalers, "grid_import")
    assert back.orderBy("ts_hour").select("grid_import").toPandas().grid_import.to_numpy() == pytest.approx(np.arange(50.0))


def test_windows(spark):
    w = X.sequence_windows(series(spark, range(100)), "grid_import", 10, 5, 5).orderBy("origin").collect()
    assert len(w) == 18 and w[0].ctx_target == list(range(10)) and w[0].target == [10, 11, 12, 13, 14]


def test_gap_fill(spark):
    assert [r.grid_import for r in X.gap_fill(series(spark, [None, 1, None, 3, None]), "grid_import").orderBy("ts_hour").collect()] == [1, 1, 1, 3, 3]


def test_nearest_prefers_the_later_of_two(spark):
    left = spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in (0, 1, 2, 9)], "t timestamp")
    right = spark.createDataFrame([(T0, 1), (T0 + dt.timedelta(hours=2), 2)], "u timestamp, v int")
    assert [r.v for r in J.nearest_join(left, right, "t", "u").orderBy("t").collect()] == [1, 2, 2, 2]
    assert [r.v for r in J.nearest_join(left, right.limit(0), "t", "u").collect()] == [None] * 4


def test_conformal_quantile(spark):
    rnd = np.random.default_rng(1)
    scores = rnd.normal(size=500)
    df = spark.createDataFrame([("a", float(x)) for x in scores] + [("b", float(x)) for x in scores[:10]] + [("c", float(x)) for x in scores[:30]], "k string, s double")
    q = lambda alpha: {r.k: r.q for r in I.conformal_quantile(df, "s", ["k"], alpha).collect()}
    got = q(0.5)
    assert got["b"] == 0 and got["a"] == pytest.approx(np.quantile(scores, np.ceil(501 * 0.5) / 500))
    assert q(0.01)["c"] == pytest.approx(scores[:30].max())


def test_intervals_are_ordered(spark, hourly):
    bt = E.run_backtest(hourly, CFG, E.naive_backend(CFG)).withColumns({"q_low": F.col("prediction") * 0.9, "q_high": F.col("prediction") * 1.1})
    out = I.apply_cqr(bt, I.cqr_two_regime(bt, ["device_id", "target"], CFG), ["device_id", "target"])
    assert out.where("not (0 <= prediction_lower and prediction_lower <= prediction and prediction <= prediction_upper)").count() == 0
    none = I.apply_offset(bt, spark.createDataFrame([("dev-A", 0.0)], "device_id string, offset double"))
    assert none.where("prediction_lower is not null or prediction_upper is not null").count() == 0


def test_metrics_and_bias(spark):
    rows = [("d", "t", T0 + dt.timedelta(days=o), h, 1.0 + h, 1.5 + h, None, None) for o in (0, 1) for h in (1, 2)]
    df = spark.createDataFrame(rows, "device_id string, target string, origin timestamp, horizon int, actual double, prediction double, lower double, upper double")
    m = A.metrics(df, ["device_id"]).first()
    assert (m.mae, m.mbe, m.rmse, m.coverage, m.n_samples) == (pytest.approx(0.5), pytest.approx(0.5), pytest.approx(0.5), None, 4)
    assert A.bias_corrected_mae(df).first().mae_bias_corrected == pytest.approx(0)
    assert A.bias_corrected_mae(df.where(F.col("origin") == F.lit(T0))).first().mae_bias_corrected is None


def test_update_equals_refit(spark, hourly):
    matrix = X.training_matrix(hourly, "grid_import", [6], CFG)
    linear = M.GroupedLinear("grid_import", ["grid_import_same_hour_1d", "hour_sin", "hour_cos"], ["device_id"])
    old, new = matrix.where("ts_hour < '2025-02-20'"), matrix.where("ts_hour >= '2025-02-20'")
    both = linear.update(linear.statistics(old), new)
    a = {r.device_id: r.coefficients for r in linear.solve(both).collect()}
    b = {r.device_id: r.coefficients for r in linear.fit(matrix).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-6, atol=1e-9) for k in a)


def test_linear_model_finds_a_line(spark):
    rows = [("g", float(x), 2.0 + 3.0 * x) for x in range(100)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    linear = M.GroupedLinear("y", ["x"], ["k"], ridge=1e-9)
    assert linear.predict(linear.fit(df), df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1e-4


def test_backtest_model_sees_only_the_past(spark, hourly):
    """Changing what lies after an origin changes no forecast made at it."""
    cut = E.backtest_origins(hourly, CFG).agg(F.min("origin")).first()[0]
    other = hourly.withColumn("grid_import", F.when(F.col("ts_hour") > F.lit(cut), F.col("grid_import") * 5 + 1).otherwise(F.col("grid_import")))
    one = spark.createDataFrame([("dev-A", cut), ("dev-B", cut)], "device_id string, origin timestamp")
    a, b = (E.linear_backend(CFG, [6, 12, 36])(df, one, "grid_import").select("device_id", "horizon", F.round("prediction", 9).alias("p")) for df in (hourly, other))
    assert a.count() == 96 and a.exceptAll(b).count() == 0


def test_benchmark_compares_the_same_cells(spark, hourly):
    out = E.benchmark(hourly, CFG, {"two_days": E.naive_backend(CFG, 48)}, n_origins=5)
    rows = {r.candidate: r for r in out["comparison"].collect()}
    assert rows["naive"].n_rows == rows["two_days"].n_rows and rows["naive"].skill_vs_naive == 0
    assert rows["two_days"].skill_vs_naive == pytest.approx(1 - rows["two_days"].mae / rows["naive"].mae)
    best = min(rows.values(), key=lambda r: r.mae).candidate
    assert out["winner"].first().winner == best


def test_records_round_trip(spark, hourly):
    o = R.forecast_origins(hourly)
    fc = M.naive_forecast(hourly, o, "grid_import", CFG)
    flat = R.forecasts_to_frame(R.forecast_records(fc))
    assert flat.count() == 96 and flat.where("grid_export_kwh <> 0 or net_exchange_kwh <> round(-grid_import_kwh, 3)").count() == 0


def test_run_log(spark, tmp_path):
    runs = spark.createDataFrame([(1, "d", T0), (2, "d", T0 + dt.timedelta(days=9))], "run_id long, device_id string, start_time timestamp")
    values = spark.createDataFrame([(1, "cv_mae", 1.0), (2, "cv_mae", 1.2), (2, "x", float("nan"))], "run_id long, key string, value double")
    assert L.clean_metrics(values).count() == 2 and L.latest_run(runs).first().run_id == 2
    assert [r.run_id for r in L.prune_runs(runs, 7, "2025-01-12").collect()] == [2] and [r.run_id for r in L.prune_runs(runs, 7, "2025-01-12", True).collect()] == [1]
    d = E.drift(runs, values).first()
    assert d.degraded and d.change == pytest.approx(0.2)

"""Nonlinear models and users' own behind the fit and predict protocol."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import backends as K
from gridloom.operators import evaluation as E
from gridloom.operators import models as M
from gridloom.operators.forests import QuantileForest, weighted_quantiles
from gridloom.schema import SchemaError

CFG = Config(min_span_days=14.0, targets=("grid_import",), backtest_origins=4)
START = dt.datetime(2025, 3, 1)


@pytest.fixture(scope="module")
def history(spark):
    rnd = np.random.default_rng(5)
    rows = [(d, START + dt.timedelta(hours=i), float(1 + k + np.sin(i * np.pi / 12) + 0.1 * rnd.normal()), float(np.sin(i * np.pi / 12)), float(np.cos(i * np.pi / 12))) for k, d in enumerate("ab") for i in range(24 * 24)]
    return spark.createDataFrame(rows, "device_id string, ts_hour timestamp, grid_import double, hour_sin double, hour_cos double").withColumns({"day_of_week": F.lit(0), "month": F.lit(3), "is_weekend": F.lit(0)}).cache()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("tables")

    def write(df):
        path = str(where / f"t{len(list(where.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_weighted_quantiles_are_order_statistics():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(30, 40))
    x[rnd.random(x.shape) < 0.3] = np.nan
    x[3] = np.nan
    got = weighted_quantiles(x, (0.25, 0.5, 1.0))
    for row, q in zip(x, got, strict=True):
        own = np.sort(row[~np.isnan(row)])
        want = [own[next(i for i in range(len(own)) if (i + 1) / len(own) >= p - 1e-9)] for p in (0.25, 0.5, 1.0)] if len(own) else [np.nan] * 3
        assert np.array_equal(q, want, equal_nan=True)


def test_forest_quantiles_by_brute_force(spark):
    """Every leaf's targets, each weighing 1 / (trees x rows of the leaf), as the forest of quantiles is defined."""
    rnd = np.random.default_rng(1)
    x = rnd.random((400, 2))
    y = x[:, 0] * 10 + rnd.normal(size=400) * (1 + 5 * x[:, 1])
    df = spark.createDataFrame([(float(a), None if i % 17 == 0 else float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))], "x1 double, x2 double, y double")
    forest = QuantileForest("y", ["x1", "x2"], trees=20, depth=4, min_rows=5, points=400)
    state = forest.fit(df)
    rows = state.model.transform(M.assembled(df, ["x1", "x2"])[0]).select("x1", "y", "_leaf").collect()
    leaf, target = np.array([r["_leaf"].toArray() for r in rows]).astype(int), np.array([r.y for r in rows])
    got = {r.x1: r for r in forest.predict(state, df).collect()}
    assert leaf.shape[1] == 20
    for i in range(0, 400, 20):
        weight = np.zeros(400)
        for t in range(20):
            same = leaf[:, t] == leaf[i, t]
            weight[same] += 1 / same.sum() / 20
        order = np.argsort(target)
        reached = np.cumsum(weight[order])
        for level, name in ((0.25, "q_low"), (0.75, "q_high")):
            assert got[rows[i].x1][name] == pytest.approx(target[order][np.searchsorted(reached, level)], abs=0.5)
    inside = np.mean([got[r.x1].q_low <= r.y <= got[r.x1].q_high for r in rows])
    assert 0.4 < inside < 0.65


def test_grouped_tweedie_equals_the_glm(spark, store):
    rnd = np.random.default_rng(2)
    rows = []
    for group, slope in (("p", 0.8), ("q", -0.5), ("zero", 0.0)):
        x = rnd.normal(size=300)
        mean = np.exp(0.3 + slope * x)
        y = np.array([rnd.gamma(2.0, m / 2) if rnd.random() < 0.6 else 0.0 for m in mean]) * (group != "zero")
        rows += [(group, float(a), float(b), float(c)) for a, b, c in zip(x, rnd.normal(size=300), y, strict=True)]
    df = spark.createDataFrame(rows, "k string, x1 double, x2 double, y double").repartition(3)
    tweedie = M.GroupedTweedie("y", ["x1", "x2"], ["k"], store=store)
    model = tweedie.fit(df)
    found = {r.k: r.coefficients for r in model.collect()}
    assert set(found) == {"p", "q"}
    for group in ("p", "q"):
        own = VectorAssembler(inputCols=["x1", "x2"], outputCol="_x").transform(df.where(F.col("k") == group))
        glm = GeneralizedLinearRegression(featuresCol="_x", labelCol="y", family="tweedie", variancePower=1.5, linkPower=0.0, tol=1e-12, maxIter=100).fit(own)
        assert found[group] == pytest.approx([glm.intercept, *glm.coefficients], abs=1e-6)
    told = tweedie.predict(model, df).collect()
    assert all((r.prediction is None) == (r.k == "zero") for r in told)
    assert all(r.prediction == pytest.approx(np.exp(np.dot(found[r.k], [1, r.x1, r.x2]))) for r in told if r.k != "zero")


class HourMean:
    """A user's own kind: the mean of the target, with a spread."""

    def __init__(self, target, features):
        self.target = target

    def fit(self, matrix):
        return matrix.agg(F.avg(self.target)).first()[0], matrix.agg(F.max("ts_hour")).first()[0]

    def predict(self, state, matrix):
        return matrix.withColumns({"prediction": F.lit(state[0]), "q_low": F.lit(state[0] - 1), "q_high": F.lit(state[0] + 1)})


def test_refits_at_each_origin_and_never_looks_ahead(history):
    origins = E.backtest_origins(history, CFG)
    moments = K.refit_moments(origins)
    assert len(moments) == 4
    fitted = K.fit_at(history, moments, "grid_import", CFG, HourMean)
    assert len(fitted) == 4 * 3 and all(f.state[1] <= f.until for f in fitted)
    mean = {f.until: f.state[0] for f in fitted if f.band == "short"}
    told = K.predict_with(fitted, history, origins, "grid_import", CFG).where("horizon <= 8").collect()
    assert len(told) == 4 * 2 * 8 and all(r.prediction == mean[r.origin] and r.lower == max(0, r.prediction - 1) and r.upper == r.prediction + 1 for r in told)


def test_weekly_refits_route_to_the_newest_model_that_is_old_enough(history):
    origins = E.backtest_origins(history, CFG, 8)
    moments = K.refit_moments(origins, 72)
    assert 1 < len(moments) < 8 and all(m.timestamp() % (72 * 3600) == 0 for m in moments)
    fitted = K.fit_at(history, moments, "grid_import", CFG, HourMean)
    mean = {f.until: f.state[0] for f in fitted if f.band == "long"}
    for r in K.predict_with(fitted, history, origins, "grid_import", CFG).where("horizon = 48").collect():
        assert r.prediction == mean[max(m for m in moments if m <= r.origin)]
    early = origins.withColumn("origin", F.lit(START - dt.timedelta(days=3)))
    assert K.predict_with(fitted, history, early, "grid_import", CFG).isEmpty()


def test_boosted_and_own_models_in_a_benchmark(spark, history, store):
    """Trees, a user's kind, overrides of one candidate and devices that are only learnt from."""
    gbt = lambda target, features: M.GbtPooled(target, features, rounds=3, depth=3)
    kinds = {
        "boosted": K.refitting(CFG, gbt, 168),
        "own": E.Candidate(lambda cfg, train: K.refitting(cfg, HourMean, train=train)),
        "pool": E.Candidate(lambda cfg, train: K.refitting(cfg, HourMean, train=train), train_devices=spark.createDataFrame([("b",)], "device_id string")),
        "other lag": E.Candidate(lambda cfg, _: E.naive_backend(cfg), {"naive_lag_hours": 48}),
    }
    done = E.benchmark(history, CFG, kinds, n_origins=2, devices=spark.createDataFrame([("a",)], "device_id string"), store=store)
    got = {r.candidate: r for r in done["comparison"].collect()}
    assert set(got) == {*kinds, "naive"} and len({r.n_rows for r in got.values()}) == 1 and got["naive"].n_rows == 2 * 48
    assert got["own"].mae != got["pool"].mae and got["other lag"].mae != got["naive"].mae and got["boosted"].mae < got["pool"].mae
    for wrong in ({"horizon": 24}, {"nonsense": 1}):
        with pytest.raises(SchemaError):
            E.benchmark(history, CFG, {"x": E.Candidate(lambda cfg, _: E.naive_backend(cfg), wrong)})


def test_fitted_models_score_and_cross_validate(history):
    ends = history.groupBy("device_id").agg(F.max("ts_hour").alias("origin"))
    fitted = K.fit_at(history, [START + dt.timedelta(days=12)], "grid_import", CFG, lambda t, f: QuantileForest(t, f, trees=5, depth=4))
    told = K.as_fitted(CFG, fitted)(history, ends, "grid_import").collect()
    assert len(told) == 96 and all(0 <= r.lower <= r.prediction <= r.upper for r in told)
    cv = E.cross_validate(history, Config(targets=("grid_import",), cv_folds=1), K.as_fitted(CFG, fitted)).collect()
    assert {r.device_id for r in cv} == {"a", "b"} and all(r.n_origins > 0 and r.cv_mae < 0.6 for r in cv)


def test_a_python_model_a_device_in_backtest_cv_and_scoring(history, raw_meters):
    """Least squares on the hour's sine: the same two functions everywhere, from no more days than asked for."""
    import pandas as pd

    from gridloom.operators import records as R


    def fit(x, y):
        assert len(x) <= 10 * 24 * CFG.horizon
        a = np.column_stack([np.ones(len(x)), x["hour_sin"]])
        return np.linalg.lstsq(a, y.to_numpy(dtype=float), rcond=None)[0]

    def predict(model, x):
        mid = model[0] + model[1] * x["hour_sin"].to_numpy(dtype=float)
        return pd.DataFrame({"prediction": mid, "q_low": mid - 0.1, "q_high": mid + 0.1})

    own = K.per_device(CFG, fit, predict, history_days=10)
    rows = E.run_backtest(history, CFG, own, n_origins=3).collect()
    assert len(rows) == 2 * 3 * 48 and np.mean([abs(r.prediction - r.actual) for r in rows]) < 0.3  # the fixture's clock is an hour off the forecast's
    assert all(0 <= r.lower <= r.prediction <= r.upper for r in rows)
    assert all((r.lower, r.upper) == pytest.approx((r.prediction - 0.1, r.prediction + 0.1)) for r in rows if r.prediction > 0.1)
    cv = E.cross_validate(history, Config(targets=("grid_import",), cv_folds=1), own).collect()
    assert all(r.cv_mae < 0.3 for r in cv) and len(cv) == 2
    told = R.batch_score(raw_meters, Config(min_span_days=14.0), own)
    assert told.count() == 96 and {"grid_import_lower", "grid_export_upper"} <= set(told.columns)
    weekly = E.run_backtest(history, CFG, K.per_device(CFG, fit, lambda model, x: [float(model[0])] * len(x), 168, 10), n_origins=3)
    assert weekly.select("device_id", "prediction").distinct().count() <= 4 and weekly.where("lower is not null").isEmpty()

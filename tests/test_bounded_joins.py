"""History joined to origins by bounded ranges, and blocks of sums, against brute force."""

from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import features as X
from gridloom.operators import gram
from gridloom.operators import joins as J
from gridloom.operators import models as M

START = dt.datetime(2025, 1, 1)
HOUR = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def series():
    rnd = np.random.default_rng(1)
    return {d: [(START + i * HOUR, float(i)) for i in range(24 * 40) if rnd.random() > gaps] for d, gaps in (("a", 0.0), ("b", 0.3), ("c", 0.95))}


@pytest.fixture(scope="module")
def history(spark, series):
    return spark.createDataFrame([(d, t, v) for d, rows in series.items() for t, v in rows], "device_id string, ts_hour timestamp, y double")


@pytest.fixture(scope="module")
def moments():
    return [(d, START + h * HOUR) for d in ("a", "b", "c", "none") for h in (-5, 0, 3, 47, 200, 333, 700, 959, 2000)]


@pytest.fixture(scope="module")
def origins(spark, moments):
    return spark.createDataFrame(moments, "device_id string, origin timestamp")


@pytest.mark.parametrize("back", [1, 24, 50, 336])
def test_history_by_hours(history, origins, series, moments, back):
    got = {(r.device_id, r.origin, r.ts_hour) for r in J.origin_join(history, origins, "history", back_hours=back).collect()}
    assert got == {(d, o, t) for d, o in moments for t, _ in series.get(d, []) if o - back * HOUR < t <= o}


@pytest.mark.parametrize("n", [1, 7, 48, 5000])
def test_history_by_rows(history, origins, series, moments, n):
    got = sorted((r.device_id, r.origin, r["_back"], r.y) for r in J.recent_rows(history, origins, n).collect())
    want = []
    for d, o in moments:
        past = [v for t, v in series.get(d, []) if t <= o]
        want += [(d, o, k, v) for k, v in enumerate(past[::-1][:n])]
    assert got == sorted(want)


def test_rows_before_the_filter_do_not_grow_with_history(spark):
    """Twenty years before one origin, or one month: as many rows meet it."""
    met = []
    for hours in (24 * 31, 24 * 365 * 20):
        df = spark.range(hours).select(F.lit("a").alias("device_id"), (F.lit(START) - F.make_interval(hours="id")).alias("ts_hour"), F.col("id").cast("double").alias("y"))
        at = spark.createDataFrame([("a", START)], "device_id string, origin timestamp")
        end = F.unix_timestamp("origin")
        near = J.in_buckets(df, at, ["device_id"], F.unix_timestamp("ts_hour"), end - 336 * 3600, end, 86_400)
        met.append(near.count())
    assert met[0] == met[1] <= 336 + 48


def test_forecasts_join_no_history_to_origins(history, origins):
    """Lags come by equality on hours: no join is on the device alone."""
    plan = X.forecast_matrix(history, origins, "y", Config())._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("ts_hour" in line or "origin" in line for line in joins)


def test_forecast_lags_never_pass_the_origin(spark, series, history):
    asked = [("a", START + h * HOUR) for h in (400, 511)]
    rows = X.forecast_matrix(history, spark.createDataFrame(asked, "device_id string, origin timestamp"), "y", Config()).collect()
    value = dict(series["a"])
    assert len(rows) == 2 * 48
    for r in rows:
        far = r.horizon > 24
        day = lambda k, r=r: value.get(r.ts_hour - dt.timedelta(days=k)) if r.ts_hour - dt.timedelta(days=k) <= r.origin else None
        assert r.y_same_hour_1d == day(2 if far else 1) and r.y_same_hour_7d == day(7) and r.y_same_hour_14d == day(14)


def test_contexts_of_irregular_rows(spark, history, origins, series, moments):
    got = {(r.device_id, r.origin): r.ctx_target for r in X.context_and_future(history.withColumn("hour_sin", F.lit(0.0)), origins, "y", 24, Config(), covariates=["hour_sin"]).collect()}
    want = {(d, o): [v for t, v in series.get(d, []) if t <= o][-24:] for d, o in moments}
    assert got == {k: v for k, v in want.items() if len(v) == 24}


@pytest.mark.parametrize("keys", [["k", "t"], ["k"], []])
def test_blocks_add_up(spark, monkeypatch, keys):
    """Many batches, more groups than a task holds, null keys and inputs, and tables of one row."""
    monkeypatch.setattr(gram, "HELD", 3)
    rnd = np.random.default_rng(2)
    rows = [(None if i % 11 == 0 else f"k{i % 5}", i % 7, float(rnd.normal()), None if i % 3 == 0 else float(rnd.normal()), float(i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, y double, x1 double, x2 double").repartition(3)
    linear = M.GroupedLinear("y", ["x1", "x2"], keys)
    linear.missing, linear.size = ["x1"], 4
    found = linear.statistics(df).collect()
    place = {"k": 0, "t": 1}
    upper = np.triu_indices(4)
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[place[k]] for k in keys), []).append(r)
    assert len(found) == len(groups)
    for r in found:
        own = groups[tuple(r[k] for k in keys)]
        x = np.array([[1, o[3] or 0.0, o[4], o[3] is None] for o in own], dtype=float)
        y = np.array([o[2] for o in own])
        assert r.n == len(own) and r.yy == pytest.approx(y @ y)
        assert r.xx == pytest.approx((x.T @ x)[upper]) and r.xy == pytest.approx(x.T @ y)


def test_running_blocks_are_prefix_sums(spark):
    parts = [("a", t, float(t), [float(t)] * 3, [1.0, float(t)]) for t in (1, 3, 5)] + [("b", 4, 1.0, [2.0] * 3, [0.0, 1.0])]
    df = spark.createDataFrame([(k, t, 10 * t, yy, xx, xy) for k, t, yy, xx, xy in parts], "k string, t int, n long, yy double, xx array<double>, xy array<double>")
    at = spark.createDataFrame(list(itertools.product(("a", "b", "c"), (0, 1, 2, 4, 9))), "k string, t int")
    got = {(r.k, r.t): (r.n, r.yy, r.xx, r.xy) for r in gram.running(df, ["k"], "t", at).collect()}
    want = {}
    for k, m in itertools.product(("a", "b", "c"), (0, 1, 2, 4, 9)):
        own = [p for p in parts if p[0] == k and p[1] <= m]
        if own:
            want[k, m] = (sum(10 * p[1] for p in own), sum(p[2] for p in own), [sum(p[3][0] for p in own)] * 3, [sum(p[4][i] for p in own) for i in (0, 1)])
    assert got == want

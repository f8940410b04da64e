"""Hand-computed cases of what SQL that repeats a formula cannot prove."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import cleaning as C
from gridloom.operators import evaluation as E
from gridloom.operators import features as X
from gridloom.operators import joins as J

CFG = Config(min_span_days=14.0)
T0 = dt.datetime(2025, 3, 1)


@pytest.fixture(scope="module")
def ramp(spark):
    """Three weeks in which hour n has the value n * n."""
    return spark.createDataFrame([("a", T0 + dt.timedelta(hours=n), float(n * n)) for n in range(21 * 24)], "device_id string, ts_hour timestamp, grid_import double")


@pytest.mark.parametrize("horizon", [6, 36])
def test_diff_7d_is_day_7_less_day_14(ramp, horizon):
    rows = {r.ts_hour: r for r in X.train_lags(ramp, "grid_import", [horizon]).collect()}
    n = 20 * 24
    r = rows[T0 + dt.timedelta(hours=n)]
    assert r.grid_import_diff_7d == (n - 168) ** 2 - (n - 336) ** 2
    assert r.grid_import_diff_1d == (n - (24 if horizon <= 24 else 48)) ** 2 - (n - 48) ** 2
    assert rows[T0 + dt.timedelta(hours=335)].grid_import_diff_7d is None


def test_forecast_diff_7d(spark, ramp):
    origin = T0 + dt.timedelta(hours=400)
    origins = spark.createDataFrame([("a", origin)], "device_id string, origin timestamp")
    for r in X.forecast_matrix(ramp, origins, "grid_import", CFG).collect():
        n = 400 + r.horizon
        assert r.grid_import_diff_7d == (n - 168) ** 2 - (n - 336) ** 2


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz"])
def test_weather_without_a_zone_is_local(spark, kind):
    walls = {"2025-07-01 12:00:00": "2025-07-01 10:00", "2025-01-01 12:00:00": "2025-01-01 11:00", "2025-03-30 02:30:00": "2025-03-30 01:00", "2025-10-26 02:30:00": None}
    df = spark.createDataFrame([(w,) for w in walls], "datetime string").withColumn("wall", F.col("datetime")).withColumn("datetime", F.col("datetime").cast(kind))
    got = {r.wall: r.datetime for r in C.prepare_weather(df, CFG).collect()}
    assert got == {w: dt.datetime.fromisoformat(u) for w, u in walls.items() if u}


def test_weather_with_a_zone_is_an_instant(spark):
    df = spark.createDataFrame([("2025-07-01T12:00:00Z",), ("2025-07-01T12:00:00+05:00",)], "datetime string")
    assert {r.datetime.hour for r in C.prepare_weather(df, CFG).collect()} == {12, 7}
    instants = spark.createDataFrame([(dt.datetime(2025, 7, 1, 12),)], "datetime timestamp")
    assert C.prepare_weather(instants, CFG).first().datetime == dt.datetime(2025, 7, 1, 12)


def test_processed_hourly_meets_local_weather(spark, raw_meters):
    weather = spark.createDataFrame([(dt.datetime(2025, 2, 10, h), float(h)) for h in range(24)], "datetime timestamp_ntz, temperature_2m double")
    rows = C.processed_hourly(raw_meters, CFG, weather).where("temperature_2m is not null").collect()
    assert rows and all(r.temperature_2m == (r.ts_hour.hour + 1) % 24 for r in rows)


@pytest.mark.parametrize("by", [None, "k"])
def test_nearest_takes_the_later_of_two(spark, by):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    left = spark.createDataFrame([(m, at(m) if m is not None else None, k) for m in (0, 5, 10, 15, 29, 100, None) for k in "ab"] * 2, "m int, t timestamp, k string")
    right = spark.createDataFrame([(at(0), 0, "a"), (at(10), 10, "a"), (at(20), 20, "a"), (at(20), 20, "a"), (at(4), 4, "b")], "at timestamp, v int, k string")
    places = {"a": [0, 10, 20], "b": [4]}
    got = J.nearest_join(left, right if by else right.where("k = 'a'").drop("k"), "t", "at", by, ["v"]).collect()
    assert len(got) == 28
    for r in got:
        options = places[r.k] if by else places["a"]
        assert r.v == (None if r.m is None else min(options, key=lambda p: (abs(p - r.m), -p)))


def test_next_time(spark):
    df = spark.createDataFrame([(n, T0 + dt.timedelta(hours=n)) for n in range(30)], "n int, t timestamp")
    cuts = spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in (5, 12, 12, 24)], "c timestamp")
    got = {r.n: r.u for r in J.next_time(df, cuts, "t", "c", "u").collect()}
    assert got == {n: T0 + dt.timedelta(hours=next(h for h in (5, 12, 24) if h >= n)) for n in range(25)}


def test_windows_are_cut_from_one_array_a_device(spark):
    rows = [("a", T0 + dt.timedelta(hours=n), float(n)) for n in range(20)] + [("b", T0, 1.0)]
    df = spark.createDataFrame(rows, "device_id string, ts_hour timestamp, y double")
    got = sorted((r.origin, r.ctx_target, r.target, r.ctx_cov) for r in X.sequence_windows(df, "y", 5, 3, 4, ["y"]).collect())
    want = []
    for i in range(5, 18, 4):
        want.append((T0 + dt.timedelta(hours=i - 1), [float(n) for n in range(i - 5, i)], [float(n) for n in range(i, i + 3)], [[float(n)] for n in range(i - 5, i)]))
    assert got == want


def test_a_candidate_without_common_cells_stays(spark):
    rows = [("naive", "d", "t", T0, 1.0, 2.0), ("good", "d", "t", T0, 1.0, 1.5), ("late", "d", "t", T0 + dt.timedelta(days=1), 1.0, 2.0)]
    df = spark.createDataFrame(rows, "candidate string, device_id string, target string, origin timestamp, actual double, prediction double")
    cells = df.where("candidate = 'good'").select("device_id", "target", "origin")
    got = {r.candidate: (r.n_rows, r.mae) for r in E.comparison(df, cells).collect()}
    assert got == {"naive": (1, 1.0), "good": (1, 0.5), "late": (0, None)}

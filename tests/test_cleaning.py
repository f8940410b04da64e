from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.functions.clock import localize_utc
from gridloom.functions.solar import clearsky_ghi
from gridloom.operators import cleaning as C
from gridloom.operators import validation as V
from gridloom.schema import SchemaError
from gridloom.sources import readers as S

CFG = Config(min_span_days=14)
METER = "device_id string, ts timestamp, consumption_kwh double, production_kwh double"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def test_rollup_sums_scales_and_counts_nulls(spark):
    rows = [("d", at(f"2025-01-01T00:{m:02d}"), 0.25, 0.5) for m in (0, 15, 30, 45)]
    rows += [("d", at(f"2025-01-01T01:{m:02d}"), 0.3, None) for m in (0, 15, 30)]
    rows += [("d", at("2025-01-01T02:00"), None, None), (None, at("2025-01-01T02:00"), 1.0, 1.0)]
    out = {r.ts_hour.hour: r for r in C.hourly_rollup(spark.createDataFrame(rows, METER), CFG).collect()}
    assert out[0].M1_cons == pytest.approx(1.0) and not out[0].partial_hour
    assert out[1].M1_cons == pytest.approx(0.9 * 4 / 3) and out[1].partial_hour and out[1].M1_prod == 0
    assert out[2].M1_cons == 0 and out[2].n_quarters == 1 and len(out) == 3


def test_targets_floor_and_nulls(spark):
    df = spark.createDataFrame([(0.01, -0.5), (0.5, 0.7), (None, 0.3)], "M1_cons double, M1_prod double")
    rows = C.derive_targets(df, CFG).collect()
    assert [(r.grid_import, r.grid_export) for r in rows] == [(0.0, 0.0), (0.5, 0.7), (None, 0.3)]
    assert rows[1].net_exchange == pytest.approx(0.2) and rows[2].net_exchange is None


@pytest.mark.parametrize("limit", [1, 2])
def test_interpolation_agrees_with_pandas(spark, limit):
    rnd = np.random.default_rng(3)
    values = rnd.random(80)
    values[rnd.random(80) < 0.4] = np.nan
    hours = pd.date_range("2025-01-01", periods=80, freq="h", tz="UTC")
    rows = [("d", h.to_pydatetime(), None if np.isnan(v) else float(v)) for h, v in zip(hours, values, strict=True)]
    df = spark.createDataFrame(rows, "device_id string, ts_hour timestamp, grid_import double")
    got = [r.grid_import for r in C.interpolate_gaps(df, ["grid_import"], limit).orderBy("ts_hour").collect()]
    want = pd.Series(values).interpolate(limit=limit)
    np.testing.assert_allclose([np.nan if g is None else g for g in got], want.to_numpy(), rtol=1e-9)


def test_outliers_agree_with_pandas(spark):
    rnd = np.random.default_rng(5)
    values = rnd.random(400)
    values[[50, 200, 333]] = 9.0
    hours = pd.date_range("2025-01-01", periods=400, freq="h", tz="UTC")
    df = spark.createDataFrame([("d", h.to_pydatetime(), float(v), float(v)) for h, v in zip(hours, values, strict=True)], "device_id string, ts_hour timestamp, grid_import double, grid_export double")
    got = [r.grid_import_outlier for r in C.outlier_flags(df, CFG).orderBy("ts_hour").collect()]
    roll = pd.Series(values).rolling(168, center=True, min_periods=24)
    want = ((pd.Series(values) - roll.mean()).abs() / (roll.std() + 1e-6) > 3).tolist()
    assert got == want and sum(got) == 3


def test_grid_covers_all_hours_of_all_devices(spark):
    df = spark.createDataFrame([("a", at("2025-01-01T00:00"), 1.0), ("b", at("2025-01-01T05:00"), 2.0)], "device_id string, ts_hour timestamp, grid_import double")
    grid = C.regular_grid(df)
    assert grid.count() == 12 and grid.where("grid_import is null").count() == 10
    assert C.regular_grid(df.limit(0)).count() == 0


def test_daylight_saving(spark):
    local = spark.createDataFrame([(1, "2025-03-30 02:30:00"), (2, "2025-10-26 02:30:00"), (3, "2025-07-01 12:00:00")], "i int, t string")
    out = {r.i: r.u for r in local.select("i", localize_utc(F.col("t").cast("timestamp"), "Europe/Rome").cast("string").alias("u")).collect()}
    assert out == {1: "2025-03-30 01:00:00", 2: None, 3: "2025-07-01 10:00:00"}


def test_processed_hourly_has_no_nan_and_is_repeatable(spark, raw_meters):
    a = C.processed_hourly(raw_meters, CFG)
    doubles = [c for c, k in a.dtypes if k == "double"]
    assert a.where(" or ".join(f"isnan({c})" for c in doubles)).count() == 0
    assert a.count() == 2 * 30 * 24 and a.exceptAll(C.processed_hourly(raw_meters.repartition(7), CFG)).where("grid_export_outlier").count() == 0


def test_sufficiency_and_gates(spark, raw_meters):
    hourly = C.processed_hourly(raw_meters, CFG)
    verdicts = {r.device_id: r for r in V.assess_sufficiency(hourly, CFG).collect()}
    assert all(v.eligible for v in verdicts.values()) and verdicts["dev-A"].energy_rows == 720
    strict = V.assess_sufficiency(hourly, Config())
    assert not strict.where("eligible").count() and "span" in strict.first().reason
    with pytest.raises(SchemaError):
        V.require_eligible(strict)
    gates = {r.device_id: (r.export_eligible, r.import_eligible) for r in V.activity_gates(hourly, CFG).collect()}
    assert gates == {"dev-A": (True, True), "dev-B": (False, True)}
    assert {(r.device_id, r.target) for r in V.target_gate(V.activity_gates(hourly, CFG)).collect()} == {("dev-A", "grid_export"), ("dev-A", "grid_import"), ("dev-B", "grid_import")}


def test_contracts(spark, raw_meters):
    assert V.validate(raw_meters) is raw_meters
    for bad, word in ((raw_meters.drop("ts"), "ts"), (raw_meters.withColumn("ts", F.col("ts").cast("string")), "ts"), (raw_meters.withColumn("consumption_kwh", F.lit("x")), "consumption_kwh"), (raw_meters.limit(0), "no rows")):
        with pytest.raises(SchemaError, match=word):
            V.validate(bad)
    with pytest.raises(SchemaError):
        V.validate(raw_meters, "weather")


def test_aliases(spark):
    df = spark.createDataFrame([("d", "2025-07-01 12:00:00", "1.5", "x")], "POD string, Timestamp string, prelievo string, immissione string")
    row = S.normalize_meters(df, "Europe/Rome").first()
    assert row.device_id == "d" and row.ts.hour in (10, 12) and row.consumption_kwh == 1.5 and row.production_kwh is None
    kept = spark.createDataFrame([(1.0, 2.0)], "consumption_kwh double, `import` double")
    assert S.normalize_meters(kept).first().consumption_kwh == 1.0
    assert S.rename_map(["id", "when", "in"]) == {"id": "device_id"}
    mapped = S.normalize_meters(spark.createDataFrame([("d", 3.0)], "sensor string, a double"), column_map={"sensor": "device_id", "a": "consumption_kwh"})
    assert mapped.first().consumption_kwh == 3.0


def test_first_source_wins(spark):
    a = spark.createDataFrame([("d", at("2025-01-01T00:00"), 1.0, 0.0)], METER)
    b = spark.createDataFrame([("d", at("2025-01-01T00:00"), 0.9, 0.0), ("d", at("2025-01-01T00:15"), 0.9, 0.0)], METER)
    assert sorted(r.consumption_kwh for r in S.merge_sources([(a, None, None), (b, None, None)]).collect()) == [0.9, 1.0]
    with pytest.raises(SchemaError):
        S.merge_sources([(a.limit(0), None, None)])


def test_tables_are_checked_by_name(spark):
    for table, filters in (("a b", None), ("t; drop", None), ("range", {"x y": 1})):
        with pytest.raises(Exception):  # noqa: B017
            S.read_table(spark, table, filters)


def test_payload(spark):
    df = spark.read.json(spark.sparkContext.parallelize(['{"hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00"], "temperature_2m": [1.5, null]}}']))
    assert [r.temperature_2m for r in S.hourly_payload_to_rows(df).orderBy("datetime").collect()] == [1.5, None]
    assert S.hourly_payload_to_rows(spark.createDataFrame([(1,)], "x int")).count() == 0


def test_weather_features(spark):
    rows = [(at(f"2025-06-21T{h:02d}:00"), 10.0 + h, float(h), 500.0 if 6 < h < 18 else 0.0) for h in range(24)]
    raw = spark.createDataFrame(rows, "datetime timestamp, temperature_2m double, cloud_cover double, shortwave_radiation double")
    out = {r.datetime.hour: r for r in C.weather_features(raw, 46.07, 11.12, CFG).collect()}
    noon = max(out.values(), key=lambda r: r.solar_elevation)
    assert 66 < noon.solar_elevation < 68 and out[0].is_daylight + out[23].is_daylight <= 1
    assert out[0].cloud_cover_diff == 0 and out[5].cloud_cover_diff == 1
    assert out[20].pv_temp_factor == pytest.approx(1 - 0.004 * 5) and out[2].heating_degree == pytest.approx(6)
    with pytest.raises(SchemaError):
        C.weather_features(raw.drop("cloud_cover"), 46, 11, CFG)
    sun = spark.range(1).select(clearsky_ghi(F.lit(1.0)).alias("a"), clearsky_ghi(F.lit(-0.2)).alias("b")).first()
    assert sun.a == pytest.approx(1098 * np.exp(-0.059)) and sun.b == 0

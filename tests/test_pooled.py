"""Pools: what the shared model and the bounds may see, who is left out, the flow from readings, and models of all others."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.functions import clock
from gridloom.operators import evaluation as E
from gridloom.operators import pooled as P
from gridloom.operators import records as R
from gridloom.operators import runlog as L
from gridloom.schema import Roles, SchemaError

CFG = Config(min_span_days=14.0, cv_folds=1, targets=("grid_import",))
START = dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc)
INPUTS = {"grid_import": ["hour_sin", "hour_cos"]}
SCHEMA = "device_id string, ts_hour timestamp, grid_import double, grid_export double"


def hourly(spark, lengths, change=lambda device, i, v: v):
    rnd, rows = random.Random(3), []
    for device, n in lengths.items():
        for i in range(n):
            v = 1 + (ord(device) - 97) / 4 + math.sin(i / 24 * 2 * math.pi) / 2 + rnd.random() / 5
            rows.append((device, START + dt.timedelta(hours=i), change(device, i, v), 0.0))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns(clock.calendar(F.col("ts_hour"), CFG.local_tz))


def pairs(spark, devices):
    return spark.createDataFrame([(d, "grid_import") for d in devices], "device_id string, target string")


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    where = tmp_path_factory.mktemp("stored")

    def write(df):
        path = str(where / f"t{len(list(where.iterdir()))}")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    return write


def coefficients(pool):
    return {r.band: np.array(r.coefficients) for r in pool["models"].collect()}


def same(a, b):
    return a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-9) for k in a)


def test_what_a_pool_sees(spark, store):
    """600 rows: the model sees rows 1 to 420, the bounds rows 421 to 510, and neither of them the rest; an excluded device leaves no trace."""
    sizes, allowed = {"a": 600, "b": 600, "c": 600, "d": 200}, pairs(spark, "abcd")
    pooled = P.PooledLinear(CFG, INPUTS, store=store)
    gone = spark.createDataFrame([("c",)], "device_id string")
    fit = lambda change=lambda device, i, v: v, gone=gone: pooled.fit(hourly(spark, sizes, change), allowed, gone)
    first = fit()
    offsets = lambda pool: {r.device_id: r.offset for r in pool["offsets"].collect()}
    assert {r.device_id for r in first["members"].collect()} == {"a", "b"} == set(offsets(first))
    assert [(r.device_id, r.reason) for r in first["dropped"].collect()] == [("d", "too few rows")]
    assert {r.band for r in first["models"].collect()} == {"short", "medium", "long"}
    assert same(coefficients(first), coefficients(fit(lambda d, i, v: v * 9 if d in "cd" else v)))
    band = fit(lambda d, i, v: v + 5 if 420 <= i < 510 else v)
    assert same(coefficients(first), coefficients(band)) and all(offsets(band)[d] > offsets(first)[d] + 3 for d in "ab")
    rest = fit(lambda d, i, v: v + 5 if i >= 510 else v)
    assert same(coefficients(first), coefficients(rest)) and offsets(first) == pytest.approx(offsets(rest))
    early = fit(lambda d, i, v: v + 5 if i < 420 else v)
    assert not same(coefficients(first), coefficients(early))
    assert not same(coefficients(first), coefficients(fit(gone=None)))


def test_members_only_and_bounds(spark, store):
    df = hourly(spark, {"a": 600, "b": 600, "c": 600})
    pooled = P.PooledLinear(CFG, INPUTS, store=store)
    pool = pooled.fit(df, pairs(spark, "ab"))
    starts = R.forecast_origins(df)
    rows = pooled.predict(pool, df, starts, "grid_import").collect()
    assert {r.device_id for r in rows} == {"a", "b"} and len(rows) == 96
    offset = {r.device_id: r.offset for r in pool["offsets"].collect()}
    for r in rows:
        assert r.upper == pytest.approx(r.prediction + offset[r.device_id])
        assert r.lower == pytest.approx(max(0.0, r.prediction - offset[r.device_id]))
    plain = pooled.fit(df, pairs(spark, "ab"), calibrate=False)
    assert "offsets" not in plain
    assert all(r.lower is None and r.upper is None for r in pooled.predict(plain, df, starts, "grid_import").collect())


def test_saved_pool_predicts_the_same(spark, store, tmp_path):
    df = hourly(spark, {"a": 600, "b": 600})
    pooled = P.PooledLinear(CFG, store=store)
    pool = pooled.fit(df, pairs(spark, "ab"))
    P.save_pool(pool, pooled, str(tmp_path / "pool"), df.columns)
    again, tables = P.load_pool(spark, str(tmp_path / "pool"), CFG)
    starts = R.forecast_origins(df)
    told = [sorted((r.device_id, r.horizon, r.prediction, r.lower, r.upper) for r in b(df, starts, "grid_import").collect()) for b in (pooled.backend(pool), again.backend(tables))]
    assert told[0] == told[1] and len(told[0]) == 96


def test_no_member(spark, store):
    """A target without members: empty tables, no forecasts."""
    df = hourly(spark, {"a": 100})
    pooled = P.PooledLinear(CFG, INPUTS, store=store)
    pool = pooled.fit(df, pairs(spark, "a"))
    assert pool["members"].isEmpty() and pool["models"].isEmpty() and pool["dropped"].count() == 1
    assert pooled.predict(pool, df, R.forecast_origins(df), "grid_import").isEmpty()


def test_flow(spark, raw_meters, store):
    """dev-B doesn't export: it is in the pool of imports only; the excluded dev-A is in none."""
    cfg = Config(min_span_days=14.0, cv_folds=1)
    done = P.train_pooled(raw_meters, cfg, store=store)
    assert {(r.device_id, r.target) for r in done["members"].collect()} == {("dev-A", "grid_export"), ("dev-A", "grid_import"), ("dev-B", "grid_import")}
    assert {(r.device_id, r.target) for r in done["cv"].collect()} == {("dev-A", "grid_export"), ("dev-A", "grid_import"), ("dev-B", "grid_import")}
    records = {r.device_id: r.forecasts for r in done["records"].collect()}
    assert {d: len(f) for d, f in records.items()} == {"dev-A": 48, "dev-B": 48}
    hour = records["dev-A"][0]
    assert 0 <= hour.grid_import_lower <= hour.grid_import_kwh <= hour.grid_import_upper
    alone = P.train_pooled(raw_meters, cfg, exclude=spark.createDataFrame([("dev-A",)], "device_id string"), cv=False, calibrate=False, store=store)
    assert "cv" not in alone and "offsets" not in alone
    assert {(r.device_id, r.target) for r in alone["forecasts"].select("device_id", "target").distinct().collect()} == {("dev-B", "grid_import")}


def test_leave_one_out_is_a_refit_without_the_device(spark, store):
    df = store(hourly(spark, {"a": 430, "b": 480, "c": 450}))
    origins = E.backtest_origins(df, CFG, 2)
    backend = P.leave_one_out_backend(CFG, ["hour_sin", "hour_cos"], store=store)
    got = {(r.device_id, r.origin, r.horizon): r.prediction for r in backend(df, origins, "grid_import").collect()}
    asked = origins.collect()
    assert len(got) == 48 * len(asked) and len({o.device_id for o in asked}) == 3
    refit = E.linear_backend(CFG, pooled=df.select("device_id").distinct(), features=["hour_sin", "hour_cos"])
    for o in asked[:3]:
        others = df.where((F.col("device_id") != o.device_id) & (F.col("ts_hour") <= F.lit(o.origin)))
        own = df.where(F.col("device_id") == o.device_id)
        # the device's clock hours, a model of the others only
        one = spark.createDataFrame([(o.device_id, o.origin)], "device_id string, origin timestamp")
        without = E.linear_backend(CFG, pooled=others.select("device_id").distinct(), features=["hour_sin", "hour_cos"])
        want = {r.horizon: r.prediction for r in without(others.unionByName(own), one, "grid_import").collect()}
        assert {h: got[(o.device_id, o.origin, h)] for h in want} == pytest.approx(want, abs=1e-9)
        mixed = {r.horizon: r.prediction for r in refit(df, one, "grid_import").collect()}
        assert mixed != pytest.approx(want, abs=1e-6)


def test_a_device_that_is_alone_has_no_model(spark, store):
    df = hourly(spark, {"a": 430})
    rows = P.leave_one_out_backend(CFG, ["hour_sin"], store=store)(df, E.backtest_origins(df, CFG, 1), "grid_import").collect()
    assert len(rows) == 48 and all(r.prediction is None for r in rows)


def test_roles(spark):
    df = spark.createDataFrame([("x", START, 1.0, "t")], "site string, at timestamp, heat double, note string")
    roles = Roles("site", "at", ("heat",))
    inside = roles.standard(df)
    assert inside.columns == ["device_id", "ts_hour", "heat", "note"] and roles.own(inside).columns == df.columns
    assert roles.settings(CFG).targets == ("heat",)
    for wrong, name in ((Roles("room", "at", ("heat",)), "room"), (Roles("site", "at", ("note",)), "note"), (Roles("site", "at", ("cold",)), "cold")):
        with pytest.raises(SchemaError, match=name):
            wrong.standard(df)
    with pytest.raises(SchemaError, match="device_id"):
        roles.standard(df.withColumn("device_id", F.lit(1)))


def test_run_tags(spark):
    reads = spark.createDataFrame([("r1", "t1"), ("r1", "t1"), ("r1", "nowhere"), ("r2", None)], "run_id string, table string")
    kind = "table string, license string, classification string, source_system string, ownership array<struct<type:string,name:string>>"
    registry = spark.createDataFrame([("t1", None, "red", None, [("owner", "ann"), ("steward", "bo")]), ("t2", "x", "x", "x", None)], kind)
    got = sorted(tuple(r) for r in L.run_tags(reads, registry, {"license": "CC0", "source_system": ""}, [("owner", "cy"), ("owner", "di")]).collect())
    own = [("license", "CC0"), ("owner.owner", "di")]
    table = [("classification", "red"), ("license", "unknown"), ("owner", "ann"), ("source_system", "unknown")]
    assert got == sorted([("r1", f"input.t1.{k}", v) for k, v in table] + [(r, k, v) for r in ("r1", "r2") for k, v in own])
    assert L.run_tags(reads, registry).where("run_id = 'r2'").isEmpty()

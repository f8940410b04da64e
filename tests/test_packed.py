"""Packed training rows give the sums, predictions and rows of the unpacked ones."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import evaluation as E
from gridloom.operators import features as X
from gridloom.operators import models as M
from gridloom.operators import packed as P

CFG = Config(min_span_days=14.0, bands=(("short", 1, 8), ("medium", 9, 30), ("long", 31, 48)))
HORIZONS = range(1, 49)


@pytest.fixture(scope="module")
def history(spark):
    """Hours with holes, a null target, and a device with few of them."""
    rnd, rows = random.Random(3), []
    for device, days in (("d1", 20), ("d2", 18), ("d3", 1)):
        for i in range(24 * days):
            if rnd.random() < 0.9:
                rows.append((device, dt.datetime(2025, 1, 1) + dt.timedelta(hours=i), None if rnd.random() < 0.1 else rnd.random() * 5, float(i % 24), i // 24 % 7))
    return spark.createDataFrame(rows, "device_id string, ts_hour timestamp, grid_import double, temperature_2m double, day_of_week int").withColumns(
        {"hour_sin": F.sin("temperature_2m"), "hour_cos": F.cos("temperature_2m"), "month": F.month("ts_hour"), "is_weekend": (F.col("day_of_week") > 4).cast("int")}
    ).repartition(3).cache()


def both(history):
    return [M.with_band(X.training_matrix(history, "grid_import", HORIZONS, CFG, pack=p), CFG) for p in (False, True)]


def test_unpacked_rows_are_the_matrix(history):
    plain, pack = both(history)
    assert pack.count() * 12 == plain.count()  # four runs: the band medium lies on both sides of 24 hours
    order = plain.columns
    assert sorted(map(str, P.unpacked(pack, "grid_import").select(order).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize(("by", "features"), [(["device_id", "band"], None), (["band"], None), (["device_id"], ["hour_sin", "horizon"]), (["device_id", "band"], ["hour_sin", "hour_cos"]), (["band"], [])])
def test_sums_and_predictions(history, by, features):
    plain, pack = both(history)
    names = [c for c in plain.columns if c not in ("device_id", "ts_hour", "grid_import", "band")] if features is None else features
    linear = M.GroupedLinear("grid_import", names, by)
    key = lambda r: tuple(r[k] for k in by)
    want, got = ({key(r): r for r in linear.statistics(m).collect()} for m in (plain, pack))
    assert want.keys() == got.keys()
    for k, r in want.items():
        assert got[k].n == r.n and got[k].yy == pytest.approx(r.yy)
        assert np.allclose(got[k].xx, r.xx) and np.allclose(got[k].xy, r.xy)
    model = linear.fit(plain).where(F.col(by[0]) != ("d2" if by[0] == "device_id" else "long")).cache()
    rows = lambda df: {(r.device_id, r.ts_hour, r.horizon): r.prediction for r in df.collect()}
    if "horizon" in names:
        predicted, told = rows(linear.predict(model, plain)), rows(linear.told(pack, {"prediction": model}, ["device_id", "ts_hour"]))
        assert predicted.keys() == told.keys() and None in predicted.values()
        assert all(v == pytest.approx(told[k]) for k, v in predicted.items())


def test_no_join_of_the_history_with_itself(history):
    """A table of few bytes was multiplied by its lags and sent to the driver to be broadcast."""
    origins = E.backtest_origins(history, CFG)
    plans = [m._jdf.queryExecution().optimizedPlan().toString() for m in (*both(history), X.forecast_matrix(history, origins, "grid_import", CFG))]
    assert all("Join" not in p for p in plans[:2])
    assert plans[2].count("Join") == 1 and "strategy=merge" in plans[2]

"""Work on devices is dealt by device, whatever adaptive execution makes of the bytes below."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators import backends as BK
from gridloom.operators import evaluation as E
from gridloom.operators import features as X
from gridloom.operators import models as M
from gridloom.operators.cleaning import processed_hourly
from gridloom.plans.base import CFG, stored


@pytest.fixture(scope="module")
def hourly(spark):
    """Forty devices of 20 days, a reading an hour."""
    begin = F.lit(dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc))
    hours = spark.range(40 * 480).select(F.concat(F.lit("dev-"), F.floor(F.col("id") / 480)).alias("device_id"), (F.col("id") % 480).alias("h"))
    meters = hours.select("device_id", (begin + F.make_dt_interval(hours=F.col("h").cast("int"))).alias("ts"), (F.col("h") % 24 / 10.0).alias("consumption_kwh"), (F.col("h") % 7 / 10.0).alias("production_kwh"))
    return processed_hourly(meters, CFG)


def test_matrix_has_many_parts(spark, hourly):
    matrix = X.training_matrix(hourly, "grid_import", range(1, 49), CFG, pack=True)
    assert matrix.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_stored_devices_have_many_files(spark, hourly):
    assert len(stored(hourly).inputFiles()) > 1


def test_a_device_is_cut_at_its_own_moments(spark, hourly):
    few = hourly.where("device_id in ('dev-0', 'dev-1')")
    matrix = M.with_band(X.training_matrix(few, "grid_import", range(1, 49), CFG, pack=True), CFG)
    at = "timestamp '2025-02-10 00:00:00'"
    moments = spark.sql(f"select 'dev-0' as device_id, {at} as at union all select 'dev-0', {at} + interval 2 days union all select 'dev-1', {at} + interval 1 hour")
    linear = M.GroupedLinear("grid_import", ["hour_sin"], ["device_id", "band"])
    parts = E.parts_until(linear, matrix, moments, few).groupBy("device_id").agg(F.count_distinct("at").alias("n"))
    assert {r.device_id: r.n for r in parts.collect()} == {"dev-0": 2, "dev-1": 1}
    sums = linear.running(E.parts_until(linear, matrix, moments, few), "at", moments.withColumn("band", F.lit("short")))
    # rows of 8 horizons up to each moment, the moment included
    assert sorted(r.n for r in sums.collect()) == [(9 * 24 + 1) * 8, (9 * 24 + 2) * 8, (11 * 24 + 1) * 8]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pooled_matrix_is_not_dealt_by_time(spark, hourly):
    table = stored(hourly)
    backend = E.linear_backend(CFG, pooled=table.select("device_id").distinct())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        plan = _plan(backend(table, E.backtest_origins(table, CFG), "grid_import"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any("SortMergeJoin [ts_hour" in line for line in plan.splitlines())


def test_rows_of_a_users_model_are_multiplied_beside_it(spark, hourly):
    table = stored(hourly)
    backend = BK.per_device(CFG, lambda x, y: float(y.mean()), lambda model, x: [model] * len(x), history_days=10)
    told = backend(table, E.backtest_origins(table, CFG), "grid_import")
    cogroup = next(line for line in _plan(told).splitlines() if "CoGroupsIn" in line)
    assert "_h#" in cogroup and "horizon#" in cogroup
    history = {(r.device_id, r.ts_hour): r.grid_import for r in table.collect()}
    one = told.where("device_id = 'dev-7' and horizon = 5").orderBy("origin").first()
    mean = sum(history["dev-7", one.origin - dt.timedelta(hours=h)] for h in range(240)) / 240
    assert one.prediction == pytest.approx(mean)

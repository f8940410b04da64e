"""Last readings by an aggregation of Spark's own, and windows that aren't turned into lists all at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridloom.streaming import streams as T

START = dt.datetime(2025, 1, 1)


def test_last_readings_without_a_number(spark, tmp_path):
    """A reading without seq is the least of its moment; no Python process holds the state."""
    rows = [("d", START, 1.0, 1.0, None), ("d", START, 2.0, None, 3), ("d", START, 9.0, 9.0, 2), ("e", START, float("nan"), 5.0, None), ("e", START + dt.timedelta(hours=9), 0.0, 0.0, 1)]
    kind = "device_id string, ts timestamp, consumption_kwh double, production_kwh double, arrived long"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = T.stream_last_readings(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), "arrived")
    assert "Python" not in out._jdf.queryExecution().analyzed().toString()
    out.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    got = {r.device_id: (r.consumption_kwh, r.production_kwh, r.arrived) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"d": (2.0, None, 3), "e": (None, 5.0, None)}


def test_windows_are_lists_a_few_at_a_time(spark):
    rows = [(f"d{i}", START, [float(i), 2.0], [[1.0], [2.0]], [[3.0], [4.0], [5.0]]) for i in range(300)]
    windows = spark.createDataFrame(rows, "device_id string, origin timestamp, ctx_target array<double>, ctx_cov array<array<double>>, future_cov array<array<double>>").coalesce(1)

    def predict(ctx, cov, future):
        assert all(type(c) is list for c in (*cov, *future))  # lists, as the type says: not arrays of a frame of all rows
        return [ctx[0] + f[0] for f in future]

    got = T.window_predictor(windows, predict)
    assert "MapInArrow" in got._jdf.queryExecution().analyzed().toString()
    found = {(r.device_id, r.horizon): r.prediction for r in got.collect()}
    assert found == {(f"d{i}", h + 1): i + 3.0 + h for i in range(300) for h in range(3)}
    assert got.agg(F.count("prediction")).first()[0] == 900

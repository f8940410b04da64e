"""Structured Streaming forms: hourly rollup, scoring of stored forecasts, and exact model updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..functions import clock
from ..operators.cleaning import derive_targets
from ..operators.models import GroupedLinear
from ..sources import versions


def stream_hourly(readings: DataFrame, cfg: Config, lateness: str = "2 hours") -> DataFrame:
    """Hourly energies of a stream of readings, in append mode.

    Readings that come later than ``lateness`` are dropped. Of repeated readings
    the first to arrive counts: append mode can't take back an hour for the last.
    """
    once = readings.where("device_id is not null").withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["device_id", "ts"])
    by = once.groupBy("device_id", F.window("ts", "1 hour").alias("w")).agg(
        F.coalesce(F.sum("consumption_kwh"), F.lit(0.0)).alias("c"), F.coalesce(F.sum("production_kwh"), F.lit(0.0)).alias("p"), F.count(F.lit(1)).alias("n_quarters")
    )
    scale = F.when(F.col("n_quarters") < 4, 4.0 / F.col("n_quarters")).otherwise(1.0)
    out = by.select("device_id", F.col("w.start").alias("ts_hour"), (F.col("c") * scale).alias("M1_cons"), (F.col("p") * scale).alias("M1_prod"), "n_quarters", (F.col("n_quarters") < 4).alias("partial_hour"))
    return derive_targets(out, cfg)


def stream_score_actuals(actuals: DataFrame, forecasts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the errors of stored forecasts as the hours' actuals (device_id, target, ts_hour, actual) arrive."""
    joined = actuals.where("actual is not null").join(forecasts, ["device_id", "target", "ts_hour"])
    scored = joined.withColumn("error", F.col("prediction") - F.col("actual"))
    return scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)


def stream_model_update(rows: DataFrame, model: GroupedLinear, path: str, checkpoint: str) -> StreamingQuery:
    """Keep one table of model statistics up to date: each batch is merged into it and makes the next version.

    A batch that is run again finds its version there and adds nothing; older versions go
    once the new one is finished, so the folder doesn't grow with the batches.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        new = lambda old: model.statistics(batch) if old is None else model.update(old, batch)
        versions.replace(batch.sparkSession, path, batch_id, new)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_statistics(spark: SparkSession, path: str) -> DataFrame | None:
    """The statistics of all rows so far; None before the first batch."""
    return versions.current(spark, path)


def stream_last_readings(readings: DataFrame, seq: str, lateness: str = "2 hours") -> DataFrame:
    """Each moment's last reading by ``seq`` (a long, such as the time of its arrival), once its hour is complete.

    The state is that of an aggregation: a row for each moment of a device until the watermark
    passes its hour's end, so corrections count whatever order they come in; what comes later is
    dropped. Readings of a batch are combined before they meet the state. Rows
    that have the same seq fall by their values, null being the least, as in ``dedupe_readings``.
    """
    known = readings.where("device_id is not null and ts is not null").withWatermark("ts", lateness)
    values = ["consumption_kwh", "production_kwh"]
    row = F.struct(F.col(seq).cast("long").alias("seq"), *(clock.not_nan(F.col(c).cast("double")).alias(c) for c in values))
    # the moment is a number here: the watermark is that of the hour
    last = known.groupBy("device_id", F.window("ts", "1 hour").alias("_hour"), F.unix_micros("ts").alias("us")).agg(F.max(row).alias("_r"))
    return last.select("device_id", F.timestamp_micros("us").alias("ts"), F.col("_r.seq").alias(seq), *(F.col(f"_r.{c}") for c in values))


#: Windows that are Python lists at a time.
WINDOWS = 128
Window = Callable[[list[float], list[list[float]], list[list[float]]], list[float]]


def window_predictor(windows: DataFrame, predict: Window) -> DataFrame:
    """Run a user's function on rows of context_and_future: (ctx_target, ctx_cov, future_cov) -> one prediction an hour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, WINDOWS):
                part = whole.slice(at, WINDOWS)
                told = [[float(v) for v in predict(*row)] for row in zip(*(part.column(c).to_pylist() for c in ("ctx_target", "ctx_cov", "future_cov")), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("device_id"), part.column("origin"), pa.array(told, pa.list_(pa.float64()))], names=["device_id", "origin", "told"])

    told = windows.select("device_id", "origin", "ctx_target", "ctx_cov", "future_cov").mapInArrow(run, "device_id string, origin timestamp, told array<double>")
    return told.select("device_id", "origin", F.posexplode("told").alias("_h", "prediction")).select("device_id", "origin", (F.col("_h") + 1).alias("horizon"), "prediction")

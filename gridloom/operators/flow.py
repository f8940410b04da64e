"""The daily run: train or refresh, forecast, log, and compare with the run before.

A root folder holds what lasts: the statistics of each target and the models as
versioned tables, and the run log. The first run (or ``full``) fits everything. Later
ones are warm: only rows that are newer than what a device's statistics have seen are
turned into features and added, which gives the point models of a refit on the same
rows; rows stay as they were cleaned when they were first seen, and bounds as they were
calibrated by the last full run. Devices that are new, and all devices
when the list of features has changed, are fitted in full.

A run is named by its time. The same run again finds its versions there, writes its
part of the log anew, and changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.clock import hours
from ..schema import SchemaError
from ..sources import versions
from . import banded as N
from . import evaluation as E
from . import features as X
from . import models as M
from . import records as R
from . import runlog as L
from . import validation as V
from .cleaning import prepare_weather, processed_hourly

#: Hours before a row that its features may look at: the longest lag, and the trailing day as of the farthest origin.
REACH = 14 * 24 + 48 + 24


def _matrix(history: DataFrame, target: str, cfg: Config, has_pv: bool) -> DataFrame:
    return M.with_band(X.training_matrix(history, target, range(1, cfg.horizon + 1), cfg, has_pv=has_pv, pack=True), cfg)


def refreshed(history: DataFrame, linear: M.GroupedLinear, target: str, cfg: Config, old: DataFrame | None, has_pv: bool = True, store: N.Store = N._as_is) -> DataFrame:
    """Statistics of all rows of ``history``: ``old`` (with upto, the last hour that each device's have seen) and what is new.

    Only ``REACH`` hours before the new rows are read for devices that have statistics.
    """
    features = F.array(*map(F.lit, linear.features)).alias("features")
    parts = []
    if old is None:
        parts.append(_matrix(history, target, cfg, has_pv))
    else:
        seen = store(old.groupBy("device_id").agg(F.min("upto").alias("upto")))
        since = seen.agg(F.min("upto")).first()[0]
        recent = history.join(seen.select("device_id"), "device_id", "left_semi").where(F.col("ts_hour") > F.lit(since) - hours(REACH))
        parts.append(_matrix(recent, target, cfg, has_pv).join(seen, "device_id").where("ts_hour > upto").drop("upto"))
        parts.append(_matrix(history.join(seen, "device_id", "left_anti"), target, cfg, has_pv))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = store(rows)
    new = linear.statistics(rows)
    sums = new if old is None else linear.update(old.select(*linear.by, "n", "yy", "xx", "xy"), rows)
    upto = rows.groupBy("device_id").agg(F.max("ts_hour").alias("upto"))
    if old is not None:
        upto = upto.unionByName(seen).groupBy("device_id").agg(F.max("upto").alias("upto"))
    return sums.join(upto, "device_id").withColumn("features", features)


def daily_run(meters: DataFrame, cfg: Config, root: str, now: dt.datetime, weather: DataFrame | None = None, full: bool = False, origin: str = "global", store: N.Store = N._as_is) -> dict[str, DataFrame]:
    """eligibility, gates, models, forecasts, records, metrics and drift of one run; raises SchemaError if no device is eligible."""
    spark = meters.sparkSession
    number, session = int(now.timestamp()), now.strftime("%Y%m%dT%H%M%S")
    hourly = store(processed_hourly(meters, cfg, weather))
    verdicts = V.assess_sufficiency(hourly, cfg)
    eligible = V.require_eligible(verdicts)
    train = store(V.only_devices(V.remove_outliers(hourly), eligible))
    gates = store(V.activity_gates(train, cfg))
    ahead = prepare_weather(weather, cfg) if weather is not None else None
    before = None if full else versions.current(spark, f"{root}/models")
    models, errors = None, []
    for target in cfg.targets:
        banded = N.BandedLinear(cfg, store=store)
        linear = banded._linear(hourly.columns, target)
        own = V.only_devices(train, gates.where("export_eligible" if target == "grid_export" else "import_eligible"))
        path = f"{root}/statistics/{target}"
        held = None if full else versions.current(spark, path)
        if held is not None:
            held = held.where(F.col("features") == F.array(*map(F.lit, linear.features)))
            held = None if held.isEmpty() else V.only_devices(held, own.select("device_id").distinct())
        versions.replace(spark, path, number, lambda _, own=own, linear=linear, target=target, held=held: refreshed(own, linear, target, cfg, held, store=store))
        stats = versions.current(spark, path)
        point = linear.solve(stats.where(F.col("n") >= banded.min_rows)).withColumnRenamed("coefficients", "_new")
        known = before.where(F.col("target") == target).drop("target") if before is not None and held is not None else None
        anew = own if known is None else own.join(known.select("device_id").distinct(), "device_id", "left_anti")
        ends = anew.groupBy("device_id").agg(F.max("ts_hour").alias("origin"))
        fresh = store(banded.fit(anew, ends, target).drop("origin"))
        both = fresh if known is None else fresh.unionByName(V.only_devices(known, own.select("device_id").distinct()))
        both = both.join(point, ["device_id", "band"], "left").withColumn("point", F.coalesce("_new", "point")).drop("_new")
        models = both.withColumn("target", F.lit(target)) if models is None else models.unionByName(both.withColumn("target", F.lit(target)))
    versions.replace(spark, f"{root}/models", number, lambda _: models)
    models = versions.current(spark, f"{root}/models")
    backend = N.fitted_backend(N.BandedLinear(cfg, store=store), models)
    starts = R.forecast_origins(hourly, origin)
    told = None
    for target in cfg.targets:
        part = N.BandedLinear(cfg, store=store).predict(models.where(F.col("target") == target).drop("target"), hourly, starts, target, ahead).where("prediction is not null")
        told = part if told is None else told.unionByName(part)
    told = store(told)
    quick = E.quick_train_mae(train, cfg, backend)
    errors.append(quick.select("device_id", F.concat(F.lit("train_mae_"), "target").alias("key"), F.col("mae").alias("value")))
    if before is None:
        done = store(E.cross_validate(train, cfg, E.linear_backend(cfg)))
        errors += [done.select("device_id", F.concat(F.lit(f"{name}_"), "target").alias("key"), F.col(column).alias("value")) for name, column in (("cv_mae", "cv_mae"), ("naive_mae", "naive_mae"))]
    each = errors[0]
    for e in errors[1:]:
        each = each.unionByName(e)
    run_id = F.concat("device_id", F.lit(f"@{session}"))
    runs = eligible.select(run_id.alias("run_id"), "device_id", F.lit(now).cast("timestamp").alias("start_time"), F.lit("full" if before is None else "warm").alias("kind"), F.lit(session).alias("session"))
    logged = L.clean_metrics(each).select(run_id.alias("run_id"), "key", "value", F.lit(session).alias("session"))
    L.log_runs(runs, f"{root}/runs", again=True)
    L.log_runs(logged, f"{root}/metrics", again=True)
    run_log, metric_log = spark.read.parquet(f"{root}/runs"), spark.read.parquet(f"{root}/metrics")
    compared = E.drift(run_log, metric_log, cfg.drift_threshold, ("cv_mae", "train_mae")).where(F.col("run_id").endswith(f"@{session}"))
    return {"eligibility": verdicts, "gates": gates, "models": models, "forecasts": told, "records": R.forecast_records(told), "metrics": metric_log.where(F.col("session") == session), "drift": compared}


def score_saved(meters: DataFrame, cfg: Config, root: str, weather: DataFrame | None = None, gated: bool = True, origin: str = "global", store: N.Store = N._as_is) -> DataFrame:
    """Flat forecasts with bounds from the newest models under ``root``; nothing is fitted. A target whose gate is shut counts as 0."""
    models = versions.current(meters.sparkSession, f"{root}/models")
    if models is None:
        raise SchemaError(f"no models in {root}")
    return R.batch_score(meters, cfg, N.fitted_backend(N.BandedLinear(cfg, store=store), models), weather, origin, gated)

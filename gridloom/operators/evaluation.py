"""Backtests, cross-validation and the comparison of backends, as joins and aggregates over tables of origins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.clock import at_least, hours
from ..schema import SchemaError
from . import features as X
from . import models as M
from . import validation as V
from .joins import forecast_hours, join_actuals, lag_lookup, long_targets, next_time
from .summaries import metrics

#: (history, origins, target) -> device_id, target, origin, ts_hour, horizon, prediction[, lower, upper]
Backend = Callable[[DataFrame, DataFrame, str], DataFrame]


def backtest_origins(df: DataFrame, cfg: Config, n: int | None = None) -> DataFrame:
    """(device_id, origin): every 24 h back from the last hour that leaves a horizon, after the warm-up."""
    count = cfg.backtest_origins if n is None else n
    ends = df.groupBy("device_id").agg(F.min("ts_hour").alias("a"), F.max("ts_hour").alias("b"))
    back = F.explode(F.sequence(F.lit(1), F.lit(count)))
    out = ends.withColumn("_i", back).withColumn("origin", F.col("b") - hours(F.col("_i") * 24 + cfg.horizon))
    return out.where(F.col("origin") >= F.col("a") + hours(cfg.warmup_days * 24)).select("device_id", "origin")


def naive_backend(cfg: Config, lag_hours: int | None = None) -> Backend:
    return lambda history, origins, target: M.naive_forecast(history, origins, target, cfg, lag_hours)


def linear_backend(cfg: Config, horizons: Sequence[int] | None = None, has_pv: bool = True, pooled: DataFrame | None = None, features: Sequence[str] | None = None, ridge: float | None = None) -> Backend:
    """Least squares per device, target and band, refitted at every origin from running daily sums.

    ``features`` restricts the inputs, by default all of the matrix.

    With ``pooled`` (the devices whose rows may be learnt from) there is one model
    of all of them for each origin; a device that is scored needs not be among them.
    """
    horizons = list(horizons or range(1, cfg.horizon + 1))

    def run(history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        # the pool is chosen by the hour, before rows are multiplied
        learnt = history if pooled is None else history.join(pooled.select("device_id"), "device_id", "left_semi")
        matrix = M.with_band(X.training_matrix(learnt, target, horizons, cfg, has_pv=has_pv, pack=True), cfg)
        names = list(features or V.resolve_features(target, cfg, has_pv, history.columns))
        by = ["band"] if pooled is not None else ["device_id", "band"]
        linear = M.GroupedLinear(target, names, by, cfg.ridge if ridge is None else ridge)
        moments = origins.select(*by[:-1], F.col("origin").alias("at"))
        model = models_as_of(linear, matrix, moments, cfg, times=history).withColumnRenamed("at", "origin")
        rows = M.with_band(X.forecast_matrix(history, origins, target, cfg, history_weather(history), has_pv), cfg)
        # models of a whole pool are few
        out = linear.predict(model if pooled is None else F.broadcast(model), rows, [*by, "origin"])
        return out.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", "prediction")

    return run


def until_own(matrix: DataFrame, moments: DataFrame) -> DataFrame:
    """Rows with _until, the first of their device's moments (device_id, at) at or after their hour, null after the last.

    A device has a few moments, which come as an array: where the matrix is dealt by device it isn't shuffled.
    """
    cuts = moments.groupBy("device_id").agg(F.sort_array(F.collect_set("at")).alias("_cuts"))
    joined = matrix.join(cuts.hint("shuffle_hash"), "device_id", "left")
    return joined.withColumn("_until", F.array_min(F.filter("_cuts", lambda c: c >= F.col("ts_hour")))).drop("_cuts")


def parts_until(linear: M.GroupedLinear, matrix: DataFrame, moments: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Statistics of each group of ``linear`` from one moment (the column ``at``) to the next, which ``running`` adds up; ``times`` holds the matrix's hours, if they are cheaper there.

    A group of one device is cut at its own moments only, and its blocks are left as the tasks made them.
    A matrix that has _until is cut already (``until_own``).
    """
    own = "device_id" in linear.by
    if "_until" in matrix.columns:
        cut = matrix
    else:
        cut = until_own(matrix, moments) if own else next_time(matrix, moments.select("at"), "ts_hour", "at", "_until", times, few=True)
    cut = cut.where("_until is not null")
    made = linear.parts if own else linear.statistics
    return made(cut, [*linear.by, "_until"]).withColumnRenamed("_until", "at")


def models_as_of(linear: M.GroupedLinear, matrix: DataFrame, moments: DataFrame, cfg: Config, min_rows: int = 1, times: DataFrame | None = None) -> DataFrame:
    """Coefficients of each group of ``linear`` and moment (its column ``at``) from the rows up to then, if there are ``min_rows`` of them.

    Sums between one moment and the next, then running sums: one pass over the
    matrix for all moments.
    """
    parts = parts_until(linear, matrix, moments, times)
    asked = moments.distinct().withColumn("band", F.explode(F.array(*[F.lit(b[0]) for b in cfg.bands])))
    return linear.solve(linear.running(parts, "at", asked).where(F.col("n") >= min_rows), [*linear.by, "at"])


def pooled_seasonal_backend(train: DataFrame, cfg: Config) -> Backend:
    """One line a target on the same hour a week before, fitted once on all devices; calls only predict.

    Hours whose week-old value lies after the origin have no prediction.
    """
    week = lambda df, target: lag_lookup(df.select("device_id", "ts_hour", target), "device_id", "ts_hour", target, [168], "_w")
    fitted = {}
    for target in cfg.targets:
        y, x = F.col(target), F.col("_w_168h")
        fitted[target] = week(train, target).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")).first()  # two numbers

    def run(history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        line = fitted[target]
        steps = forecast_hours(origins.select("device_id", "origin"), cfg.horizon).withColumn("_at", F.col("ts_hour") - hours(168))
        past = history.select("device_id", F.col("ts_hour").alias("_at"), F.col(target).alias("_x"))
        known = F.when(F.col("_at") <= F.col("origin"), F.col("_x"))
        out = steps.join(past, ["device_id", "_at"], "left").withColumn("prediction", at_least(F.lit(line.intercept) + F.lit(line.slope) * known, 0.0))
        return out.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", "prediction")

    return run


def history_weather(history: DataFrame) -> DataFrame | None:
    """The weather columns of the hourly table as a weather table."""
    columns = [c for c in ("global_tilted_irradiance", "shortwave_radiation", "cloud_cover", "temperature_2m", "clearsky_index", "effective_solar_pv", "heating_degree", "cooling_degree", "is_daylight", "solar_elevation", "cloud_cover_diff", "pv_temp_factor", "ghi_ramp") if c in history.columns]
    if not columns:
        return None
    return history.groupBy(F.col("ts_hour").alias("datetime")).agg(*(F.max(c).alias(c) for c in columns))


def run_backtest(df: DataFrame, cfg: Config, backend: Backend, devices: DataFrame | None = None, n_origins: int | None = None, gate: DataFrame | None = None) -> DataFrame:
    """device_id, target, origin, horizon, ts_hour, actual, prediction, lower, upper, hour_local (and is_daylight).

    ``gate`` holds the (device_id, target) pairs to score; a cell needs twelve hours with an actual.
    """
    if devices is not None:
        df = df.join(devices.select("device_id"), "device_id", "left_semi")
    origins = backtest_origins(df, cfg, n_origins)
    keep = [c for c in ("hour_local", "is_daylight") if c in df.columns]
    out = None
    for target in cfg.targets:
        part = backend(df, origins, target)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    out = out.withColumns({c: F.lit(None).cast("double") for c in ("lower", "upper") if c not in out.columns})
    scored = join_actuals(out.where("prediction is not null"), long_targets(df, cfg.targets, keep=keep), cfg.min_matched_hours)
    return scored if gate is None else scored.join(gate.select("device_id", "target"), ["device_id", "target"], "left_semi")


def cv_origins(df: DataFrame, cfg: Config) -> DataFrame:
    """(device_id, fold, test_start, origin): folds of a week back from the end, origins every 24 h while a horizon is left in the fold."""
    ends = df.groupBy("device_id").agg(F.min("ts_hour").alias("a"), F.max("ts_hour").alias("b"))
    out = ends.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(cfg.cv_folds))))
    out = out.withColumn("test_start", F.col("b") - hours(F.col("fold") * cfg.cv_test_days * 24))
    per_fold = (cfg.cv_test_days * 24 - cfg.horizon) // 24 + 1
    out = out.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(per_fold - 1)))).withColumn("origin", F.col("test_start") + hours(F.col("_k") * 24))
    return out.where(F.col("origin") > F.col("a")).select("device_id", "fold", "test_start", "origin")


def cross_validate(df: DataFrame, cfg: Config, backend: Backend) -> DataFrame:
    """device_id, target, cv_mae, naive_mae, skill, n_origins: means over origins of each origin's error."""
    folds = cv_origins(df, cfg)
    origins = folds.select("device_id", "origin").distinct()
    actual = long_targets(df, cfg.targets)
    enough = folds.join(long_targets(df, cfg.targets).where("actual is not null"), "device_id")
    inside = (F.col("ts_hour") > F.col("test_start")) & (F.col("ts_hour") <= F.col("test_start") + hours(cfg.cv_test_days * 24))
    enough = enough.where(inside).groupBy("device_id", "target", "origin").agg(F.count_distinct("ts_hour").alias("n")).where("n >= 24").select("device_id", "target", "origin")
    parts = []
    for name, one in (("model", backend), ("naive", naive_backend(cfg))):
        for target in cfg.targets:
            parts.append(join_actuals(one(df, origins, target).where("prediction is not null").select("device_id", "target", "origin", "ts_hour", "prediction"), actual, cfg.min_matched_hours).withColumn("who", F.lit(name)))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    both = both.join(enough, ["device_id", "target", "origin"], "left_semi")
    each = both.groupBy("device_id", "target", "origin").agg(*(F.avg(F.when(F.col("who") == w, F.abs(F.col("prediction") - F.col("actual")))).alias(w) for w in ("model", "naive")))
    out = each.where("model is not null").groupBy("device_id", "target").agg(F.avg("model").alias("cv_mae"), F.avg("naive").alias("naive_mae"), F.count(F.lit(1)).alias("n_origins"))
    return out.withColumn("skill", F.when(F.col("naive_mae") > 0, 1 - F.col("cv_mae") / F.col("naive_mae")))


def pooled_cv(df: DataFrame, cfg: Config, predict: Backend) -> DataFrame:
    """device_id, target, cv_mae, n_origins of one shared model that is fitted already: it predicts at each fold's origins and is never refitted.

    An origin needs 24 hours of its horizon in the table, and twelve of them with an actual.
    """
    origins = cv_origins(df, cfg).select("device_id", "origin").distinct()
    hours_there = forecast_hours(origins, cfg.horizon).join(df.select("device_id", "ts_hour"), ["device_id", "ts_hour"])
    origins = hours_there.groupBy("device_id", "origin").agg(F.count(F.lit(1)).alias("n")).where("n >= 24").select("device_id", "origin")
    out = None
    for target in cfg.targets:
        part = predict(df, origins, target).where("prediction is not null").select("device_id", "target", "origin", "ts_hour", "prediction")
        out = part if out is None else out.unionByName(part)
    scored = join_actuals(out, long_targets(df, cfg.targets), cfg.min_matched_hours)
    each = scored.groupBy("device_id", "target", "origin").agg(F.avg(F.abs(F.col("prediction") - F.col("actual"))).alias("mae"))
    return each.groupBy("device_id", "target").agg(F.avg("mae").alias("cv_mae"), F.count(F.lit(1)).alias("n_origins"))


def quick_train_mae(df: DataFrame, cfg: Config, backend: Backend) -> DataFrame:
    """device_id, target, mae on the last horizon's hours, which the model may have seen."""
    origins = df.groupBy("device_id").agg((F.max("ts_hour") - hours(cfg.horizon)).alias("origin"))
    out = None
    for target in cfg.targets:
        part = backend(df, origins, target).select("device_id", "target", "origin", "ts_hour", "prediction")
        out = part if out is None else out.unionByName(part)
    scored = join_actuals(out.where("prediction is not null"), long_targets(df, cfg.targets), cfg.min_matched_hours)
    return scored.groupBy("device_id", "target").agg(F.avg(F.abs(F.col("prediction") - F.col("actual"))).alias("mae"))


def per_origin_mae(rows: DataFrame) -> DataFrame:
    return rows.groupBy("candidate", "device_id", "target", "origin").agg(F.avg(F.abs(F.col("prediction") - F.col("actual"))).alias("mae"))


def common_cells(per_origin: DataFrame) -> DataFrame:
    """(device_id, target, origin) that every candidate with any rows has scored."""
    scored = per_origin.where("mae is not null").select("candidate", "device_id", "target", "origin").distinct()
    every = F.broadcast(scored.agg(F.count_distinct("candidate").alias("_all")))
    return scored.groupBy("device_id", "target", "origin").agg(F.count(F.lit(1)).alias("_n")).join(every, F.col("_n") == F.col("_all")).select("device_id", "target", "origin")


def comparison(rows: DataFrame, cells: DataFrame, naive: str = "naive") -> DataFrame:
    """candidate, mae, rmse, mbe, n_rows, skill_vs_naive on the same cells for all."""
    same = rows.join(cells, ["device_id", "target", "origin"], "left_semi")
    by = metrics(same, ["candidate"]).select("candidate", "mae", "rmse", "mbe", F.col("n_samples").alias("n_rows"))
    # a candidate without a common cell stays, with no rows
    by = rows.select("candidate").distinct().join(by, "candidate", "left").na.fill(0, ["n_rows"])
    base = F.max(F.when(F.col("candidate") == naive, F.col("mae"))).over(Window.partitionBy())
    return by.withColumn("skill_vs_naive", F.when(base > 0, 1 - F.col("mae") / base))


def pick_winner(compared: DataFrame, naive: str = "naive") -> DataFrame:
    """One row: the candidate of least error if it is strictly below the naive one's, else the naive one."""
    best = compared.where(F.col("candidate") != naive).agg(F.min_by("candidate", F.struct("mae", "candidate")).alias("best"), F.min("mae").alias("mae"))
    base = compared.where(F.col("candidate") == naive).agg(F.min("mae").alias("base"))
    return best.join(F.broadcast(base)).select(F.when(F.col("base").isNull() | (F.col("mae") < F.col("base")), F.col("best")).otherwise(F.lit(naive)).alias("winner"))


#: Settings that all candidates of a benchmark share.
SHARED = frozenset({"targets", "horizon", "backtest_origins", "warmup_days", "min_matched_hours"})


class Candidate(NamedTuple):
    """A backend that a benchmark makes itself.

    make: (settings, rows to learn from or None) -> backend; ``overrides`` are settings
    of this candidate only; ``train_devices`` (device_id) are learnt from besides the scored ones.
    """

    make: Callable[[Config, DataFrame | None], Backend]
    overrides: Mapping[str, object] = MappingProxyType({})
    train_devices: DataFrame | None = None


def benchmark(
    df: DataFrame, cfg: Config, candidates: Mapping[str, Backend | Candidate], n_origins: int = 21, devices: DataFrame | None = None, store: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> dict[str, DataFrame]:
    """comparison, per_origin and winner of named backends; the naive one always takes part.

    Origins, horizon and targets are the benchmark's for all candidates, so that their cells can be
    compared; an override of them raises SchemaError, as does one of an unknown setting.

    ``store`` may write the scored rows and read them again: the three results
    use them several times.
    """
    if "naive" in candidates:
        raise SchemaError("naive: the name is taken")
    rows = None
    for name, backend in {**candidates, "naive": naive_backend(cfg)}.items():
        if isinstance(backend, Candidate):
            wrong = [k for k in backend.overrides if k not in Config.__dataclass_fields__ or k in SHARED]
            if wrong:
                raise SchemaError(f"{name}: {', '.join(sorted(wrong))} can't be overridden")
            train = None
            if backend.train_devices is not None:
                learnt = backend.train_devices.select("device_id")
                learnt = (learnt if devices is None else learnt.unionByName(devices.select("device_id"))).distinct()
                train = df.join(learnt, "device_id", "left_semi") if devices is not None else df
            backend = backend.make(replace(cfg, **backend.overrides), train)
        part = run_backtest(df, cfg, backend, devices, n_origins).withColumn("candidate", F.lit(name)).select("candidate", "device_id", "target", "origin", "horizon", "ts_hour", "actual", "prediction")
        rows = part if rows is None else rows.unionByName(part)
    rows = store(rows)
    per_origin = per_origin_mae(rows)
    compared = comparison(rows, common_cells(per_origin))
    return {"comparison": compared, "per_origin": per_origin, "winner": pick_winner(compared)}


def evaluate_forecasts(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """device_id, target, mae, rmse, coverage (a fraction) and hours of stored forecasts against later hours (device_id, target, ts_hour, actual)."""
    joined = forecasts.join(actuals.where("actual is not null"), ["device_id", "target", "ts_hour"])
    out = metrics(joined.withColumnsRenamed({"prediction_lower": "lower", "prediction_upper": "upper"}), ["device_id", "target"])
    return out.select("device_id", "target", "mae", "rmse", (F.col("coverage") / 100).alias("coverage") if "coverage" in out.columns else F.lit(None).cast("double").alias("coverage"), F.col("n_samples").alias("n_hours"))


def drift(runs: DataFrame, run_metrics: DataFrame, threshold: float = 0.15, keys: Sequence[str] = ("cv_mae",)) -> DataFrame:
    """device_id, key, previous, current, change, degraded: each run's errors against the device's run before.

    ``keys``: beginnings of the names of the metrics that are compared.
    """
    named = F.lit(False)
    for key in keys:
        named = named | F.col("key").startswith(key)
    rows = run_metrics.where(named).join(runs.select("run_id", "device_id", "start_time"), "run_id")
    before = F.lag("value").over(Window.partitionBy("device_id", "key").orderBy("start_time", "run_id"))
    rows = rows.withColumn("previous", before).where("previous > 0")
    change = (F.col("value") - F.col("previous")) / F.col("previous")
    return rows.select("device_id", "key", "run_id", "previous", F.col("value").alias("current"), change.alias("change"), (change > threshold).alias("degraded"))

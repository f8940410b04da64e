"""Models that are fitted on a matrix, as backends of backtests, cross-validation, benchmarks and scoring.

A model kind has ``fit(matrix)`` and ``predict(state, matrix)``, which adds prediction and,
if it has them, q_low and q_high. The states are kept in a list with what each was
fitted for: target, band, and the last hour it has seen. A row to be forecast is routed
to the newest state of its target and band that is not younger than its origin.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple, Protocol

import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.clock import at_least, hours
from . import evaluation as E
from . import features as X
from . import models as M
from . import packed
from . import validation as V


class Model(Protocol):
    """What a user's own kind of model needs; with ``takes_packed = True`` it is given packed rows (``packed``) to fit on."""

    def fit(self, matrix: DataFrame) -> Any: ...

    def predict(self, state: Any, matrix: DataFrame) -> DataFrame: ...


#: Models that are fitted at the same time.
FITS = 4

#: (target, features) -> a model, not yet fitted.
Kind = Callable[[str, Sequence[str]], Model]


class Fitted(NamedTuple):
    target: str
    band: str
    #: the last hour that it may have seen
    until: dt.datetime
    model: Model
    state: Any


def refit_moments(origins: DataFrame, every_hours: int | None = None) -> list[dt.datetime]:
    """When models are fitted for these origins: at each, or at the last multiple of ``every_hours`` before each. As many as the calendar has, not as the fleet has devices."""
    at = F.col("origin") if every_hours is None else F.timestamp_seconds(F.floor(F.unix_timestamp("origin") / (every_hours * 3600)) * (every_hours * 3600))
    return sorted(r[0] for r in origins.select(at.alias("at")).distinct().collect())


def fit_at(history: DataFrame, moments: Sequence[dt.datetime], target: str, cfg: Config, kind: Kind, has_pv: bool = True, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[Fitted]:
    """A model of all devices' rows for each band and moment; moments before the first row give none."""
    names = V.resolve_features(target, cfg, has_pv, history.columns)
    pack = getattr(kind(target, names), "takes_packed", False)
    matrix = store(M.with_band(X.training_matrix(history, target, range(1, cfg.horizon + 1), cfg, has_pv=has_pv, pack=pack), cfg))

    def fit(until: dt.datetime, band: str) -> Fitted | None:
        rows = matrix.where((F.col("band") == band) & (F.col("ts_hour") <= F.lit(until)))
        if rows.isEmpty():
            return None
        model = kind(target, names)
        return Fitted(target, band, until, model, model.fit(rows))

    # a fit is many short jobs, one after the other; those of several models fill the cluster
    with ThreadPoolExecutor(FITS) as pool:
        return [f for f in pool.map(inheritable_thread_target(matrix.sparkSession)(lambda at: fit(*at)), [(until, band) for until in moments for band, *_ in cfg.bands]) if f is not None]


def predict_with(fitted: Sequence[Fitted], history: DataFrame, origins: DataFrame, target: str, cfg: Config, weather: DataFrame | None = None, has_pv: bool = True) -> DataFrame:
    """device_id, target, origin, ts_hour, horizon, prediction, lower and upper from fitted models; rows without one go."""
    weather = E.history_weather(history) if weather is None else weather
    rows = M.with_band(X.forecast_matrix(history, origins, target, cfg, weather, has_pv), cfg)
    out = None
    for band, *_ in cfg.bands:
        own = sorted((f for f in fitted if f.target == target and f.band == band), key=lambda f: f.until)
        for f, after in zip(own, [*own[1:], None], strict=True):
            mine = rows.where((F.col("band") == band) & (F.col("origin") >= F.lit(f.until)))
            mine = mine if after is None else mine.where(F.col("origin") < F.lit(after.until))
            told = f.model.predict(f.state, mine)
            bounds = [F.greatest(F.lit(0.0), F.least("q_low", "prediction")).alias("lower"), F.greatest("q_high", "prediction").alias("upper")] if "q_low" in told.columns else [F.lit(None).cast("double").alias(c) for c in ("lower", "upper")]
            part = told.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", "prediction", *bounds)
            out = part if out is None else out.unionByName(part)
    return out if out is not None else rows.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", *(F.lit(None).cast("double").alias(c) for c in ("prediction", "lower", "upper"))).limit(0)


def refitting(cfg: Config, kind: Kind, every_hours: int | None = None, train: DataFrame | None = None, has_pv: bool = True, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> E.Backend:
    """A backend that fits at each origin, or every so many hours, on what was known then.

    ``train``: the rows to learn from, if not those that are scored.
    """

    def run(history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        fitted = fit_at(history if train is None else train, refit_moments(origins, every_hours), target, cfg, kind, has_pv, store)
        return predict_with(fitted, history, origins, target, cfg, has_pv=has_pv)

    return run


def as_fitted(cfg: Config, fitted: Sequence[Fitted], has_pv: bool = True) -> E.Backend:
    """A backend that predicts with fitted models and never refits."""
    return lambda history, origins, target: predict_with(fitted, history, origins, target, cfg, has_pv=has_pv)


#: (features, target) -> whatever a model is; (model, features) -> predictions, or a table of prediction and, if it has them, q_low and q_high.
Fit = Callable[[pd.DataFrame, pd.Series], Any]
Predict = Callable[[Any, pd.DataFrame], Any]


def per_device(cfg: Config, fit: Fit, predict: Predict, every_hours: int | None = None, history_days: int = 365, has_pv: bool = True) -> E.Backend:
    """Any Python model, one a device, as a backend of backtests, cross-validation and scoring.

    A device's training rows meet its rows to forecast in one group. Each origin (or every
    so many hours before it) has a model of its own, from the ``history_days`` up to then;
    older rows aren't sent, so a group has at most horizon rows for each hour of
    these days and of the days that its origins span. Devices without rows then get no forecast.
    """

    def run(history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        at = F.col("origin") if every_hours is None else F.timestamp_seconds(F.floor(F.unix_timestamp("origin") / (every_hours * 3600)) * (every_hours * 3600))
        asked = X.forecast_matrix(history, origins, target, cfg, E.history_weather(history), has_pv).withColumn("_at", at)
        first = origins.groupBy("device_id").agg((F.min(at) - hours(history_days * 24)).alias("_first"))
        # rows packed by band meet their device's origins, and are multiplied by the horizons there, a device at a time
        matrix = X.training_matrix(history, target, range(1, cfg.horizon + 1), cfg, has_pv=has_pv, pack=True).join(first.hint("shuffle_hash"), "device_id").where("ts_hour > _first").drop("_first")
        names = V.resolve_features(target, cfg, has_pv, history.columns)
        back = pd.Timedelta(days=history_days)
        columns = ["device_id", "target", "origin", "ts_hour", "horizon", "prediction", "lower", "upper"]

        def each(table: pa.Table, asked: pa.Table) -> pa.Table:
            known = packed.frame(table, target, ["ts_hour", target, *names]).sort_values("ts_hour", ignore_index=True) if table.num_rows else None
            out = []
            for moment, rows in asked.to_pandas().groupby("_at"):
                if known is None:
                    continue
                first, last = known["ts_hour"].searchsorted(moment - back, "right"), known["ts_hour"].searchsorted(moment, "right")
                past = known.iloc[first:last]
                if past.empty:
                    continue
                told = predict(fit(past[names], past[target]), rows[names])
                told = told.reset_index(drop=True) if isinstance(told, pd.DataFrame) else pd.DataFrame({"prediction": list(told)})
                part = rows[["device_id", "origin", "ts_hour", "horizon"]].reset_index(drop=True).assign(target=target, prediction=told["prediction"].astype(float))
                bounds = {b: told[q].astype(float) if q in told else float("nan") for b, q in (("lower", "q_low"), ("upper", "q_high"))}
                out.append(part.assign(**bounds)[columns])
            return pa.Table.from_pandas(pd.concat(out) if out else pd.DataFrame(columns=columns), arrow, preserve_index=False)

        kind = "device_id string, target string, origin timestamp, ts_hour timestamp, horizon int, prediction double, lower double, upper double"
        text, at_utc, number = pa.string(), pa.timestamp("us", "UTC"), pa.float64()
        arrow = pa.schema(list(zip(columns, (text, text, at_utc, at_utc, pa.int32(), number, number, number), strict=True)))
        known = matrix.select(F.col("device_id").alias("_device"), *(F.col(c).alias(c) for c in matrix.columns if c != "device_id"))  # names of its own: both sides come from one table
        found = known.groupBy("_device").cogroup(asked.groupBy("device_id")).applyInArrow(each, kind)
        none = lambda c: F.when(~F.isnan(c), F.col(c))
        point, low, high = at_least(none("prediction"), 0.0), none("lower"), none("upper")
        bounds = {"lower": F.when(low.isNotNull(), F.greatest(F.lit(0.0), F.least(low, point))), "upper": F.when(high.isNotNull(), F.greatest(high, point))}
        return found.withColumns({"prediction": point, **bounds})

    return run

"""Forecasts with calibrated intervals: fitting and predicting apart, and the flow from readings to records.

A fitted model is a table, one row a device, target and band (and origin, where
models of several pasts are fitted at once), so it is saved, joined and scored
like any other table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..functions.clock import at_least, calendar
from . import evaluation as E
from . import features as X
from . import intervals as I
from . import models as M
from . import packed
from . import records as R
from . import validation as V
from .cleaning import prepare_weather, processed_hourly

Store = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


#: A log-link point is cut at e^30.
HIGHEST = 30.0


def conformal(scores: np.ndarray, coverage: float, least: int) -> float:
    """The finite-sample quantile of scores; 0 unless there are more than ``least``."""
    n = len(scores)
    return float(np.quantile(scores, min(np.ceil((n + 1) * coverage - 1e-12) / n, 1.0))) if n > least else 0.0


def regimes(x: np.ndarray, y: np.ndarray, hour: np.ndarray, cut: int, half: Sequence[float] | None, point: Sequence[float], levels: tuple[float, float], least: int, coverage: float, link: str = "identity") -> tuple:
    """Shifts of each hour of the day from the first ``cut`` rows' errors; threshold, q_active and q_idle from the others."""
    if half is None or cut == 0:
        return None, None, None, None
    base = np.maximum(x @ np.asarray(half), 0.0)
    error = (y - base)[:cut]
    order = np.argsort(hour[:cut], kind="stable")
    names, begin = np.unique(hour[:cut][order], return_index=True)
    shifts = {int(h): np.quantile(e, levels).tolist() for h, e in zip(names, np.split(error[order], begin[1:]), strict=True)}
    table = np.full((24, 2), np.nan)
    for h, q in shifts.items():
        table[h] = q
    bounds = base[cut:, None] + table[hour[cut:]]
    told = ~np.isnan(bounds[:, 0])
    if not told.any():
        return shifts, None, None, None
    seen, predicted = y[cut:][told], x[cut:][told] @ np.asarray(point)
    predicted = np.exp(np.minimum(predicted, HIGHEST)) if link == "log" else np.maximum(predicted, 0.0)
    score = np.maximum(bounds[told, 0] - seen, seen - bounds[told, 1])
    threshold = float(np.median(predicted))
    active = predicted - threshold > abs(threshold) * 1e-12  # as intervals.above
    return shifts, threshold, conformal(score[active], coverage, least), conformal(score[~active], coverage, least)


class BandedLinear:
    """Point, low and high per device, target and band.

    The point model learns from all rows up to its origin. The bounds learn from
    the first ``cfg.cqr_split`` of the hours: a line of their own, shifted by the
    quantiles of its errors at each hour of the day. The hours that are left
    calibrate them (two-regime conformal corrections). A device with fewer than
    ``min_rows`` training rows in any band has no model.

    ``features`` restricts the inputs; ``store`` may write tables that several
    steps use and read them again. With link "log" the point model is one of zero-inflated
    targets (``GroupedTweedie``), fitted round by round, so a device has one origin only.
    A model's row says which link its point has.
    """

    def __init__(self, cfg: Config, features: Sequence[str] | None = None, has_pv: bool = True, ridge: float | None = None, min_rows: int = 100, store: Store = _as_is, link: str = "identity") -> None:
        if link not in ("identity", "log"):
            raise ValueError(f"link: {link!r}")
        self.link = link
        self.cfg, self.features, self.has_pv, self.min_rows, self.store = cfg, features, has_pv, min_rows, store
        self.ridge = cfg.ridge if ridge is None else ridge

    def _linear(self, columns: Sequence[str], target: str) -> M.GroupedLinear:
        names = V.resolve_features(target, self.cfg, self.has_pv, columns) if self.features is None else self.features
        return M.GroupedLinear(target, names, ["device_id", "band"], self.ridge)

    def _hour(self) -> Column:
        return calendar(F.col("ts_hour"), self.cfg.local_tz)["hour_local"]

    def _split(self, history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        """device_id, origin, cut: the last hour that the bounds learn from."""
        # hours are numbered once; an origin takes the number that it stands at, and the hour that has the share's
        own = Window.partitionBy("device_id").orderBy("_t", "_side")
        known = history.where(F.col(target).isNotNull()).select("device_id", F.col("ts_hour").alias("_t"), F.lit(0).alias("_side")).distinct()
        both = known.unionByName(origins.select("device_id", F.col("origin").alias("_t"), F.lit(1).alias("_side")))
        both = both.withColumn("_i", F.sum(1 - F.col("_side")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        asked = both.where("_side = 1").select("device_id", F.col("_t").alias("origin"), F.floor(F.col("_i") * self.cfg.cqr_split).alias("_i"))
        return asked.join(both.where("_side = 0").select("device_id", "_i", F.col("_t").alias("cut")).hint("merge"), ["device_id", "_i"]).drop("_i")

    def fit(self, history: DataFrame, origins: DataFrame, target: str) -> DataFrame:
        """(device_id, origin, band) with point, half, shifts, threshold, q_active and q_idle, each from the rows up to its origin."""
        cfg, by = self.cfg, ["device_id", "origin", "band"]
        origins = origins.select("device_id", "origin").distinct()
        linear = self._linear(history.columns, target)
        moments = self._split(history, origins, target).select("device_id", "origin", "cut", F.inline(F.array(
            F.struct(F.lit("point").alias("kind"), F.col("origin").alias("at")), F.struct(F.lit("half").alias("kind"), F.col("cut").alias("at")))))
        moments = self.store(moments)
        matrix = M.with_band(X.training_matrix(history, target, range(1, cfg.horizon + 1), cfg, has_pv=self.has_pv, pack=True), cfg)
        inside = packed.varying(target)
        arrays = dict.fromkeys(["_h", *(inside[f] for f in linear.features if f in inside)])
        matrix = matrix.select("device_id", "ts_hour", "band", target, *(f for f in linear.features if f not in inside), *arrays)
        # cut before it is stored, while it is dealt by device
        matrix = self.store(E.until_own(matrix, moments.select("device_id", "at")))
        solved = E.models_as_of(linear, matrix, moments.select("device_id", "at"), cfg, self.min_rows)
        pick = lambda k: F.max_by("coefficients", F.when(F.col("kind") == k, 1)).alias(k)
        model = moments.join(solved, ["device_id", "at"]).groupBy(*by, "cut").agg(pick("point"), pick("half"))
        whole = model.where("point is not null").groupBy("device_id", "origin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(cfg.bands))
        model = self.store(self._linked(matrix, model.join(whole.drop("_n"), ["device_id", "origin"]), linear, target))

        return self._calibrated(matrix, model, linear, target)

    def _linked(self, matrix: DataFrame, model: DataFrame, linear: M.GroupedLinear, target: str) -> DataFrame:
        """``model`` with its link, and with the log link's point where there is one (a target of zeros has none)."""
        if self.link == "identity":
            return model.withColumn("link", F.lit("identity"))
        model = self.store(model)
        if not model.groupBy("device_id").agg(F.count_distinct("origin").alias("n")).where("n > 1").isEmpty():
            raise ValueError("a log link is fitted for one origin a device")
        rows = packed.unpacked(matrix.join(model.select("device_id", "band", "origin"), ["device_id", "band"]).where("ts_hour <= origin"), target)
        fitted = M.GroupedTweedie(target, linear.features, ["device_id", "band"], ridge=max(self.ridge, 1e-6), tolerance=1e-6, store=self.store).fit(rows)
        both = model.join(fitted.withColumnRenamed("coefficients", "_log"), ["device_id", "band"], "left")
        return both.withColumns({"link": F.when(F.col("_log").isNotNull(), "log").otherwise("identity"), "point": F.coalesce("_log", "point")}).drop("_log")

    def _calibrated(self, matrix: DataFrame, model: DataFrame, linear: M.GroupedLinear, target: str) -> DataFrame:
        """``model`` with the shifts and corrections of each origin.

        A group of one device and band, whose hours are bounded by time, meets its models:
        per origin the errors are one matrix product, and no row is multiplied by the origins.
        """
        cfg, features = self.cfg, linear.features
        layout = packed.Layout(target, features, linear.missing)
        low, high, least, coverage = cfg.quantile_low, cfg.quantile_high, cfg.cqr_min_rows, cfg.cqr_coverage
        rows = matrix.select("device_id", "band", "ts_hour", self._hour().cast("int").alias("hour"), F.col(target).cast("double").alias("_y"), *layout.columns())
        new = T.StructType.fromDDL("shifts map<int,array<double>>, threshold double, q_active double, q_idle double")
        schema = T.StructType([*model.drop("cut").schema.fields, *new.fields])

        def run(hours: pa.Table, models: pa.Table) -> pa.Table:
            hours = hours.take(pa.compute.sort_indices(hours, sort_keys=[("ts_hour", "ascending")]))
            x, of = layout.whole(hours.columns[5:])
            y, clock = hours.column("_y").to_numpy()[of], hours.column("hour").to_numpy()[of]
            at = hours.column("ts_hour").cast(pa.int64()).to_numpy()[of]
            out = []
            for m in models.select(["point", "half", "link"]).append_column("o", models.column("origin").cast(pa.int64())).append_column("c", models.column("cut").cast(pa.int64())).to_pylist():
                upto = np.searchsorted(at, m["o"], "right")
                out.append(regimes(x[:upto], y[:upto], clock[:upto], np.searchsorted(at[:upto], m["c"], "right"), m["half"], m["point"], (low, high), least, coverage, m["link"]))
            shifts = pa.array([list(o[0].items()) if o[0] else None for o in out], pa.map_(pa.int32(), pa.list_(pa.float64())))
            rest = [pa.array([o[i] for o in out], pa.float64()) for i in (1, 2, 3)]
            kept = models.drop_columns(["cut"])
            return pa.Table.from_arrays([*kept.columns, shifts, *rest], names=[*kept.column_names, "shifts", "threshold", "q_active", "q_idle"])

        return rows.groupBy("device_id", "band").cogroup(model.groupBy("device_id", "band")).applyInArrow(run, schema)

    def _bounds(self, df: DataFrame) -> DataFrame:
        shift = F.element_at("shifts", F.col("hour"))
        return df.withColumns({"q_low": F.col("_base") + shift[0], "q_high": F.col("_base") + shift[1]})

    def predict(self, model: DataFrame, history: DataFrame, origins: DataFrame, target: str, weather: DataFrame | None = None) -> DataFrame:
        """device_id, target, origin, ts_hour, horizon, prediction, prediction_lower, prediction_upper.

        A model with origins predicts at each its own; one without them predicts at all.
        """
        weather = E.history_weather(history) if weather is None else weather
        rows = M.with_band(X.forecast_matrix(history, origins, target, self.cfg, weather, self.has_pv), self.cfg)
        linear = self._linear([*history.columns, *(weather.columns if weather is not None else ())], target)
        joined = rows.join(model, [k for k in ("device_id", "origin", "band") if k in model.columns], "left")
        told = linear.dot("point")
        told = F.when(F.col("link") == "log", F.exp(F.least(told, F.lit(HIGHEST)))).otherwise(at_least(told, 0.0))
        joined = joined.withColumns({"prediction": F.when(F.col("point").isNotNull(), told), "_base": at_least(linear.dot("half"), 0.0), "hour": self._hour()})
        out = I.bounded(self._bounds(joined))
        return out.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", "prediction", "prediction_lower", "prediction_upper")


def _as_backend(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"prediction_lower": "lower", "prediction_upper": "upper"})


def interval_backend(banded: BandedLinear) -> E.Backend:
    """Fits at every origin from what was known then, as the backtest and the cross-validation ask."""
    return lambda history, origins, target: _as_backend(banded.predict(banded.fit(history, origins, target), history, origins, target))


def fitted_backend(banded: BandedLinear, models: DataFrame) -> E.Backend:
    """Predicts with fitted models (device_id, target, band, …), and never refits: for batch scoring and pooled checks."""
    return lambda history, origins, target: _as_backend(banded.predict(models.where(F.col("target") == target).drop("target"), history, origins, target))


def train_forecast(meters: DataFrame, cfg: Config, weather: DataFrame | None = None, cv: bool = True, origin: str = "global", store: Store = _as_is, import_link: str = "identity") -> dict[str, DataFrame]:
    """Readings -> eligibility, gates, models, cv, forecasts (with bounds) and records of all devices that have enough data.

    Outliers are left out of training and kept as history to forecast from. A
    target is modelled where its activity gate is open, imports by a model of zero-inflated
    targets if ``import_link`` is "log"; import models of devices
    without export use the weather inputs meant for them. Raises SchemaError if
    no device is eligible.
    """
    hourly = store(processed_hourly(meters, cfg, weather))
    verdicts = V.assess_sufficiency(hourly, cfg)
    eligible = V.require_eligible(verdicts)
    train = V.remove_outliers(hourly)
    gates = store(V.only_devices(V.activity_gates(train, cfg), eligible))
    ahead = prepare_weather(weather, cfg) if weather is not None else None
    ends = train.groupBy("device_id").agg(F.max("ts_hour").alias("origin"))
    starts = R.forecast_origins(hourly, origin)
    # with weather the inputs of an import model depend on whether its device exports
    groups = [(t, pv) for t in cfg.targets for pv in ((True, False) if weather is not None and t == "grid_import" else (True,))]
    out: dict[str, DataFrame] = {}
    for target, has_pv in groups:
        allowed = gates.where("export_eligible" if target == "grid_export" else "import_eligible")
        if (target, not has_pv) in groups:
            allowed = allowed.where(F.col("export_eligible") == has_pv)
        banded = BandedLinear(cfg, has_pv=has_pv, store=store, link=import_link if target == "grid_import" else "identity")
        own, past, at = (V.only_devices(df, allowed) for df in (train, hourly, starts))
        model = store(banded.fit(own, V.only_devices(ends, allowed), target).drop("origin"))
        parts = {"models": model.withColumn("target", F.lit(target)), "forecasts": banded.predict(model, past, at, target, ahead).where("prediction is not null")}
        if cv:
            one = replace(cfg, targets=(target,))
            parts["cv"] = E.cross_validate(own, one, E.linear_backend(one, has_pv=has_pv))
        for name, part in parts.items():
            out[name] = out[name].unionByName(part) if name in out else part
    forecasts = store(out["forecasts"])
    return {**out, "eligibility": verdicts, "gates": gates, "forecasts": forecasts, "records": R.forecast_records(forecasts)}

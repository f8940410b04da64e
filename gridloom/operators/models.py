"""Forecast backends: seasonal naive, grouped least squares, and pooled MLlib models.

A backend fits on a matrix of features and predicts rows of features; the
fitted state is always a table, so saving it is writing it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.clock import at_least, hours
from . import gram, packed
from .joins import forecast_hours


def with_band(df: DataFrame, cfg: Config) -> DataFrame:
    """Adds band, the name of the range that the horizon is in."""
    band: Column = F.lit(None).cast("string")
    horizon = F.get("_h", F.lit(0)) if packed.is_packed(df) else F.col("horizon")
    for name, first, last in reversed(cfg.bands):
        band = F.when(horizon.between(first, last), F.lit(name)).otherwise(band)
    return df.withColumn("band", band)


def naive_forecast(df: DataFrame, origins: DataFrame, target: str, cfg: Config, lag_hours: int | None = None) -> DataFrame:
    """device_id, target, origin, ts_hour, horizon, prediction: the value lag_hours earlier.

    A row that is there without a value counts as 0; a row that isn't there gives null.
    Horizons longer than the lag would look past the origin, and give null too.
    """
    lag = cfg.naive_lag_hours if lag_hours is None else lag_hours
    steps = forecast_hours(origins.select("device_id", "origin"), cfg.horizon).withColumn("_at", F.col("ts_hour") - hours(lag))
    last = df.groupBy("device_id", F.col("ts_hour").alias("_at")).agg(F.max(F.coalesce(target, F.lit(0.0))).alias("_v"))
    known = F.when(F.col("_at") <= F.col("origin"), F.greatest("_v", F.lit(0.0)))
    out = steps.join(last, ["device_id", "_at"], "left").withColumn("prediction", F.when(F.col("_v").isNotNull(), known))
    return out.select("device_id", F.lit(target).alias("target"), "origin", "ts_hour", "horizon", "prediction")


def seasonal_linear(matrix: DataFrame, target: str, by: Sequence[str] = ("device_id",)) -> DataFrame:
    """Slope and intercept of the target on the same hour a week before."""
    x = F.col(f"{target}_same_hour_7d")
    return matrix.groupBy(*by).agg(F.regr_slope(F.col(target), x).alias("slope"), F.regr_intercept(F.col(target), x).alias("intercept"), F.regr_count(F.col(target), x).alias("n"))


class GroupedLinear:
    """Ridge regression per group from sums of products.

    The sums are blocks made where the rows are (``gram``), so fitting is one shuffle of
    blocks whatever the number of groups; sums of disjoint rows add up, so a new day is an exact update and
    running sums over days give the model as of every past day at once. Missing
    features enter as 0 with an indicator of their own.
    """

    def __init__(self, target: str, features: Sequence[str], by: Sequence[str], ridge: float = 1e-3) -> None:
        self.target, self.features, self.by, self.ridge = target, list(features), list(by), ridge
        # only lags are ever missing: weather is filled, and the calendar is always there
        self.missing = [f for f in self.features if f.startswith(f"{target}_")]
        self.size = 1 + len(self.features) + len(self.missing)

    def _row(self) -> Column:
        values = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in self.features]
        return F.array(F.lit(1.0), *values, *(F.col(f).isNull().cast("double") for f in self.missing))

    def parts(self, matrix: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """Blocks of sums of products, one a group and task, or more."""
        rows = matrix.where(F.col(self.target).isNotNull())
        blocks = packed.blocks if packed.is_packed(rows) else gram.blocks
        return blocks(rows, list(by or self.by), self.target, self.features, self.missing)

    def statistics(self, matrix: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """One row a group: n, yy and the sums of products as arrays (the upper triangle, and with the target)."""
        return gram.merged(self.parts(matrix, by), list(by or self.by), self.size)

    def update(self, stats: DataFrame, new: DataFrame) -> DataFrame:
        """Statistics of old and new rows together."""
        return gram.merged(stats.unionByName(self.statistics(new)), self.by, self.size)

    def running(self, parts: DataFrame, time: str, at: DataFrame) -> DataFrame:
        """Statistics of parts of time -> those of all rows up to each moment of ``at`` (by and time), also where no part ends."""
        return gram.running(parts, self.by, time, at)

    def solve(self, stats: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """Coefficients of each row of statistics; a small symmetric system a row, in Arrow batches."""
        keys, size, ridge = list(keys or self.by), self.size, self.ridge
        upper = np.triu_indices(size)

        def run(batches):
            for pdf in batches:
                out = []
                for n, xx, xy in zip(pdf["n"], pdf["xx"], pdf["xy"], strict=True):
                    a = np.zeros((size, size))
                    a[upper] = np.asarray(xx)
                    a = a + np.triu(a, 1).T
                    scale = np.sqrt(np.maximum(np.diag(a) / max(n, 1), 1e-12))
                    lhs = a / n / np.outer(scale, scale) + ridge * np.eye(size)
                    lhs[0, 0] -= ridge  # the intercept isn't shrunk
                    out.append((np.linalg.lstsq(lhs, np.asarray(xy) / n / scale, rcond=None)[0] / scale).tolist())
                yield pd.concat([pdf[keys], pd.Series(out, index=pdf.index, name="coefficients", dtype=object)], axis=1)

        schema = stats.select(*keys).withColumn("coefficients", F.array().cast("array<double>")).schema
        return stats.select(*keys, "n", "xx", "xy").mapInPandas(run, schema)

    def fit(self, matrix: DataFrame) -> DataFrame:
        return self.solve(self.statistics(matrix))

    def predict(self, model: DataFrame, matrix: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """Adds prediction, never below 0; null for groups without a model."""
        joined = matrix.join(model, list(keys or self.by), "left")
        return joined.withColumn("prediction", at_least(self.dot("coefficients"), 0.0)).drop("coefficients")

    def told(self, matrix: DataFrame, models: Mapping[str, DataFrame], keep: Sequence[str]) -> DataFrame:
        """Rows of a packed matrix, one a horizon: the columns ``keep``, horizon, and each model's prediction under its name, as ``predict`` gives it."""
        return packed.unpacked(self.told_packed(matrix, models, keep), self.target, list(models))

    def told_packed(self, matrix: DataFrame, models: Mapping[str, DataFrame], keep: Sequence[str]) -> DataFrame:
        """The columns ``keep`` of a packed matrix, its horizons, and an array of each model's predictions at them."""
        for name, model in models.items():
            matrix = matrix.join(model.withColumnRenamed("coefficients", name), self.by, "left")
        arrays = packed.dotted(matrix, self.target, self.features, self.missing, list(models), list(dict.fromkeys([*keep, "_h"])))
        return arrays.withColumns({name: F.transform(name, lambda x: at_least(x, 0.0)) for name in models})

    def dot(self, coefficients: str) -> Column:
        """The features of a row times the named column of coefficients; null without them."""
        return F.aggregate(F.zip_with(self._row(), coefficients, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def assembled(matrix: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Trees and GLMs take no nulls: each feature gets a value of 0 and an indicator."""
    filled = {f"_f_{f}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features} | {f"_m_{f}": F.col(f).isNull().cast("double") for f in features}
    return matrix.withColumns(filled), list(filled)


class GbtPooled:
    """One boosted model of all devices' rows; ``validation`` names a boolean column of rows to stop early on."""

    def __init__(self, target: str, features: Sequence[str], rounds: int = 20, depth: int = 5, seed: int = 42, validation: str | None = None) -> None:
        self.target, self.features = target, list(features)
        extra = {"validationIndicatorCol": validation} if validation else {}
        self.estimator = GBTRegressor(featuresCol="_x", labelCol="_label", maxIter=rounds, maxDepth=depth, seed=seed, **extra)

    def _prepare(self, matrix: DataFrame) -> tuple[DataFrame, VectorAssembler]:
        rows, inputs = assembled(matrix, self.features)
        return rows, VectorAssembler(inputCols=inputs, outputCol="_x")

    def fit(self, matrix: DataFrame) -> PipelineModel:
        rows, assembler = self._prepare(matrix.where(F.col(self.target).isNotNull()).withColumn("_label", F.col(self.target).cast("double")))
        return PipelineModel([assembler, self.estimator.fit(assembler.transform(rows))])

    def predict(self, model: PipelineModel, matrix: DataFrame) -> DataFrame:
        rows, inputs = assembled(matrix, self.features)
        out = model.transform(rows)
        return out.withColumn("prediction", at_least(F.col("prediction"), 0.0)).drop("_x", *inputs)


class TweedieImport(GbtPooled):
    """Zero-inflated targets: a generalised linear model with compound Poisson-gamma errors and a log link."""

    def __init__(self, target: str, features: Sequence[str], variance_power: float = 1.5, regularisation: float = 0.01) -> None:
        self.target, self.features = target, list(features)
        self.estimator = GeneralizedLinearRegression(featuresCol="_x", labelCol="_label", family="tweedie", variancePower=variance_power, linkPower=0.0, regParam=regularisation)


class GroupedTweedie:
    """Zero-inflated targets per group: compound Poisson-gamma errors, log link, by iteratively reweighted least squares.

    A round is one pass: each row meets its group's coefficients, and weighted blocks of
    sums of products are merged as those of least squares are. The coefficients are a
    table, one row a group, written by ``store`` after each round. A group whose target
    is 0 everywhere has no maximum and no model.
    """

    def __init__(self, target: str, features: Sequence[str], by: Sequence[str], power: float = 1.5, rounds: int = 25, tolerance: float = 1e-8, ridge: float = 0.0, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
        self.linear = GroupedLinear(target, features, by, ridge)
        self.target, self.features, self.by = target, list(features), list(by)
        self.power, self.rounds, self.tolerance, self.store = power, rounds, tolerance, store

    def fit(self, matrix: DataFrame) -> DataFrame:
        """by and coefficients."""
        size = self.linear.size
        layout, inputs, weight = None, self.features, F.lit(1)
        if packed.is_packed(matrix):
            layout, weight = packed.Layout(self.target, self.features, self.linear.missing), F.size("_h")
            inputs = [*layout.plain, *dict.fromkeys(["_h", *layout.arrays])]
        rows = self.store(matrix.where(F.col(self.target).isNotNull()).select(*dict.fromkeys(["device_id", *self.by] if "device_id" in matrix.columns else self.by), self.target, *inputs))
        begin = rows.groupBy(*self.by).agg((F.sum(F.col(self.target) * weight) / F.sum(weight)).alias("_m")).where("_m > 0")
        model = self.store(begin.select(*self.by, F.concat(F.array(F.log("_m")), F.array_repeat(F.lit(0.0), size - 1)).alias("coefficients")))
        for _ in range(self.rounds):
            parts = gram.reweighted(rows.join(model, self.by), self.by, self.target, self.features, self.linear.missing, "coefficients", self.power, layout)
            new = self.linear.solve(gram.merged(parts, self.by, size))
            both = self.store(new.join(model.withColumnRenamed("coefficients", "_old"), self.by))
            step = both.agg(F.max(F.array_max(F.zip_with("coefficients", "_old", lambda a, b: F.abs(a - b) / (1 + F.abs(b)))))).first()[0]
            model = both.drop("_old")
            if step is None or step < self.tolerance:
                break
        return model

    def predict(self, model: DataFrame, matrix: DataFrame) -> DataFrame:
        """Adds prediction; null for groups without a model."""
        joined = matrix.join(model, self.by, "left")
        if packed.is_packed(matrix):
            told = packed.dotted(joined, self.target, self.features, self.linear.missing, ["coefficients"], [*dict.fromkeys(["device_id", "ts_hour", *self.by, self.target, "_h"])])
            return packed.unpacked(told, self.target, ["coefficients"]).withColumn("prediction", F.exp("coefficients")).drop("coefficients")
        return joined.withColumn("prediction", F.exp(self.linear.dot("coefficients"))).drop("coefficients")


def quantile_leaf(train: DataFrame, rows: DataFrame, target: str, features: Sequence[str], low: float = 0.25, high: float = 0.75, depth: int = 6, min_rows: int = 30) -> DataFrame:
    """Adds q_low and q_high: the target's quantiles among the training rows of the same leaf of a tree fitted for it."""
    known, inputs = assembled(train.where(F.col(target).isNotNull()).withColumn("_label", F.col(target).cast("double")), features)
    assembler = VectorAssembler(inputCols=inputs, outputCol="_x")
    tree = DecisionTreeRegressor(featuresCol="_x", labelCol="_label", maxDepth=depth, minInstancesPerNode=min_rows, leafCol="_leaf", predictionCol="_mean").fit(assembler.transform(known))
    leafed = lambda df: tree.transform(assembler.transform(df))
    # values are counted first: an hour's target stands in many rows, and only these counts are sorted
    counted = leafed(known).groupBy("_leaf", F.col("_label").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    by = counted.groupBy("_leaf").agg(F.percentile("_v", F.lit(low), F.col("_n")).alias("q_low"), F.percentile("_v", F.lit(high), F.col("_n")).alias("q_high"))
    return leafed(assembled(rows, features)[0]).select(*rows.columns, "_leaf").join(by, "_leaf", "left").drop("_leaf")

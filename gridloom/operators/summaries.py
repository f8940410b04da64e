"""Summaries of fleets, forecasts and errors. Every one is a built-in aggregation with partial sums before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import WEATHER_COLUMNS
from ..functions.clock import at_least


def segment_devices(df: DataFrame, net_threshold: float = 0.1) -> DataFrame:
    by = df.where("not gap_flag").groupBy("device_id").agg(
        F.avg("grid_import").alias("mean_import"), F.avg("grid_export").alias("mean_export"), F.avg("net_exchange").alias("mean_net"),
        F.stddev_samp("net_exchange").alias("std_net"), (F.avg(F.when(F.col("net_exchange") > 0, 1.0).otherwise(0.0)) * 100).alias("surplus_pct"),
    )
    kind = F.when(F.col("mean_net") > net_threshold, "Net Exporter").when(F.col("mean_net") < -net_threshold, "Net Importer").otherwise("Balanced")
    return by.select("device_id", *(F.bround(c, 4).alias(c) for c in ("mean_import", "mean_export", "mean_net", "std_net", "surplus_pct")), kind.alias("segment"))


def hourly_profiles(df: DataFrame) -> DataFrame:
    return df.where("not gap_flag").groupBy("hour_local").agg(*(F.avg(c).alias(c) for c in ("grid_import", "grid_export", "net_exchange")))


def weather_correlations(df: DataFrame, daylight_only: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """target, weather, correlation over complete rows; all pairs in one aggregation."""
    columns = [c for c in (columns or (*WEATHER_COLUMNS, "ghi_ramp")) if c in df.columns]
    targets = ("grid_import", "grid_export", "net_exchange")
    if daylight_only and "is_daylight" in df.columns:
        df = df.where("is_daylight = 1")
    df = df.where("not gap_flag").dropna(subset=[*targets, *columns])
    one = df.agg(*(F.corr(t, w).alias(f"{t}|{w}") for t in targets for w in columns))
    pairs = F.array(*(F.struct(F.lit(t).alias("target"), F.lit(w).alias("weather"), F.bround(f"{t}|{w}", 3).alias("correlation")) for t in targets for w in columns))
    return one.select(F.inline(pairs))


def metrics(df: DataFrame, by: Sequence[str], mape_threshold: float = 0.1) -> DataFrame:
    """rmse, mae, mbe, mape (%, of actuals not near zero), coverage (%, of rows with both bounds) and n_samples."""
    error = F.col("prediction") - F.col("actual")
    out = [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("mbe"),
        (F.avg(F.when(F.abs("actual") >= mape_threshold, F.abs(error / F.col("actual")))) * 100).alias("mape"),
    ]
    if "lower" in df.columns:
        inside = F.col("actual").between(F.col("lower"), F.col("upper")).cast("double")
        out.append((F.avg(F.when(F.col("lower").isNotNull() & F.col("upper").isNotNull(), inside)) * 100).alias("coverage"))
    return df.groupBy(*by).agg(*out, F.count(F.lit(1)).alias("n_samples"))


def summarize_backtest(df: DataFrame, bias: bool = False) -> dict[str, DataFrame]:
    """by_device, by_target and by_horizon of a backtest, and with ``bias`` what correcting the bias would give."""
    rounded = lambda d, keys: d.select(*keys, *(c if c == "n_samples" else F.bround(c, 4).alias(c) for c in d.columns if c not in keys))
    out = {
        "by_device": rounded(metrics(df, ["device_id", "target"]), ["device_id", "target"]),
        "by_target": rounded(metrics(df, ["target"]), ["target"]),
        "by_horizon": rounded(metrics(df, ["target", "horizon"]).select("target", "horizon", "mae"), ["target", "horizon"]),
    }
    if bias:
        corrected = bias_corrected_mae(df)
        out["by_device"] = out["by_device"].join(corrected, ["device_id", "target"], "left")
        mean = corrected.groupBy("target").agg(F.avg("mae_bias_corrected").alias("mae_bias_corrected"))
        out["by_target"] = out["by_target"].join(mean, "target", "left")
    return out


def backtest_rollup(df: DataFrame) -> DataFrame:
    """The three summaries' errors by grouping sets, from one scan: null keys stand for all."""
    error = F.col("prediction") - F.col("actual")
    sets = df.groupingSets([[F.col("device_id"), F.col("target")], [F.col("target")], [F.col("target"), F.col("horizon")]], F.col("device_id"), F.col("target"), F.col("horizon"))
    return sets.agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("n_samples"))


def per_horizon_bias(df: DataFrame, by: Sequence[str] = ("device_id", "target")) -> DataFrame:
    return df.groupBy(*by, "horizon").agg(F.avg(F.col("prediction") - F.col("actual")).alias("bias"))


def apply_bias(df: DataFrame, bias: DataFrame, by: Sequence[str] = ("device_id", "target"), clip_min: float | None = 0.0) -> DataFrame:
    """Predictions less their horizon's bias; a horizon without one is left as it is."""
    joined = df.join(bias, [*by, "horizon"], "left")
    fixed = F.col("prediction") - F.coalesce("bias", F.lit(0.0))
    return joined.withColumn("prediction", fixed if clip_min is None else at_least(fixed, clip_min)).drop("bias")


def bias_corrected_mae(df: DataFrame) -> DataFrame:
    """device_id, target, mae_bias_corrected: bias from the earlier half of the complete origins, error on the later half."""
    cells = df.groupBy("device_id", "target", "origin", "horizon").agg(F.avg("prediction").alias("prediction"), F.avg("actual").alias("actual"))
    own, series = Window.partitionBy("device_id", "target", "origin"), Window.partitionBy("device_id", "target")
    cells = cells.withColumn("_has", F.count(F.col("prediction") - F.col("actual")).over(own))
    cells = cells.withColumn("_all", F.size(F.collect_set("horizon").over(series)))
    cells = cells.where("_has = _all").withColumn("_rank", F.dense_rank().over(series.orderBy("origin")))
    cells = cells.withColumn("_half", F.floor(F.max("_rank").over(series) / 2))
    bias = per_horizon_bias(cells.where("_rank <= _half"))
    later = cells.where("_half > 0 and _rank > _half").join(bias, ["device_id", "target", "horizon"])
    fixed = at_least(F.col("prediction") - F.col("bias"), 0.0)
    found = later.groupBy("device_id", "target").agg(F.avg(F.abs(fixed - F.col("actual"))).alias("mae_bias_corrected"))
    return df.select("device_id", "target").distinct().join(found, ["device_id", "target"], "left")


def pinball_loss(df: DataFrame, actual: str, predictions: str, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Mean pinball loss of an array of quantile predictions."""
    levels = F.array(*[F.lit(float(q)) for q in quantiles])
    one = F.zip_with(F.col(predictions), levels, lambda p, q: F.greatest(q * (F.col(actual) - p), (q - 1) * (F.col(actual) - p)))
    total = F.aggregate(one, F.lit(0.0), lambda a, x: a + x) / F.size(predictions)
    return df.groupBy(*by).agg(F.avg(total).alias("pinball_loss"))


def run_summary(eligibility: DataFrame, forecasts: DataFrame, cv: DataFrame) -> dict[str, DataFrame]:
    """What a run did: counts, skipped devices with reasons, mean skill, and each device's energy over the horizon."""
    totals = forecasts.groupBy("device_id").agg(
        F.sum("grid_export_kwh").alias("export_kwh"), F.sum("grid_import_kwh").alias("import_kwh"), F.sum("net_exchange_kwh").alias("net_kwh")
    )
    counts = eligibility.agg(F.count_if("eligible").alias("n_eligible"), F.count(F.lit(1)).alias("n_devices"))
    return {"counts": counts, "skipped": eligibility.where("not eligible").select("device_id", "reason"), "skill": cv.groupBy("target").agg(F.avg("skill").alias("mean_skill")), "totals": totals}

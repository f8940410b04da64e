"""Model inputs: lags by horizon, training and forecast matrices, splits, scaling and sequence windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import clock
from . import packed
from .joins import by_device, forecast_hours, nearest_join, recent_rows
from .validation import resolve_features

_DAYS = (1, 2, 3, 4, 5, 6, 7, 14)


def roll_24h(df: DataFrame, value: str, key: str = "device_id", ts: str = "ts_hour", min_rows: int = 12) -> DataFrame:
    """Adds <value>_roll_24h_mean and _std over (t - 24 h, t], null with fewer than min_rows values."""
    span = Window.partitionBy(key).orderBy(F.unix_timestamp(ts)).rangeBetween(-23 * 3600, 0)
    enough = F.count(value).over(span) >= min_rows
    return df.withColumns({f"{value}_roll_24h_mean": F.when(enough, F.avg(value).over(span)), f"{value}_roll_24h_std": F.when(enough, F.stddev_samp(value).over(span))})


def _lag_columns(target: str, horizon: Column, parity: bool) -> dict[str, Column]:
    """The lag features from the day lags d1..d14 of the forecast hour.

    Day 1 lies after the origin for horizons over 24 h: the first feature takes
    day 2 then, and the mean leaves day 1 out (``parity`` keeps it in).
    """
    far = horizon > 24
    d = {k: F.col(f"_d{k}") for k in _DAYS}
    first = F.when(far, d[2]).otherwise(d[1])
    days = [F.when(~far | F.lit(parity), d[1]), *(d[k] for k in range(2, 8))]
    n = sum((x.isNotNull().cast("int") for x in days), F.lit(0))
    total = sum((F.coalesce(x, F.lit(0.0)) for x in days), F.lit(0.0))
    return {
        f"{target}_same_hour_1d": first, f"{target}_same_hour_2d": d[2], f"{target}_same_hour_3d": d[3], f"{target}_same_hour_7d": d[7],
        f"{target}_same_hour_14d": d[14], f"{target}_mean_same_hour_7d": F.when(n > 0, total / n),
        f"{target}_diff_1d": first - d[2], f"{target}_diff_7d": d[7] - d[14],
    }


def _day_lags(value: str) -> dict[str, Column]:
    """The values whole days before a row, each a window of one hour: a device's rows are ordered once for all."""
    own = Window.partitionBy("device_id").orderBy(F.unix_timestamp("ts_hour"))
    return {f"_d{k}": F.max(value).over(own.rangeBetween(-k * 86_400, -k * 86_400)) for k in _DAYS}


def _with_days(df: DataFrame, history: DataFrame, target: str) -> DataFrame:
    """The history's values whole days before the hours of ``df``, which are ordered among the history's own."""
    there = history.select("device_id", "ts_hour", F.col(target).alias("_v"), F.lit(False).alias("_asked"))
    both = df.withColumn("_asked", F.lit(True)).unionByName(there, allowMissingColumns=True)
    return by_device(both).withColumns(_day_lags("_v")).where("_asked").drop("_asked", "_v")


def _with_roll(df: DataFrame, history: DataFrame, target: str, at: str) -> DataFrame:
    """The trailing day as it stood at column ``at``."""
    names = [f"{target}_roll_24h_mean", f"{target}_roll_24h_std"]
    rolled = roll_24h(history.select("device_id", "ts_hour", target), target).select("device_id", F.col("ts_hour").alias(at), *names)
    return df.join(rolled.hint("merge"), ["device_id", at], "left")  # as long as the history, however few bytes its file has


def _seen(df: DataFrame, target: str, horizons: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """A row an hour: its day lags, and _seen, the trailing days of all its possible origins by their second."""
    names, at = [f"{target}_roll_24h_mean", f"{target}_roll_24h_std"], F.unix_timestamp("ts_hour")
    base = roll_24h(by_device(df.select("device_id", "ts_hour", target, *keep)), target).withColumns(_day_lags(target))
    before = Window.partitionBy("device_id").orderBy(at).rangeBetween(-max(horizons) * 3600, -min(horizons) * 3600)
    seen = F.collect_list(F.struct(at.alias("key"), F.struct(*names).alias("value"))).over(before)
    return base.withColumn("_seen", F.map_from_entries(seen)).drop(*names)


def train_lags(df: DataFrame, target: str, horizons: Sequence[int], parity: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(device_id, ts_hour, horizon, origin) with the target, its lag features as known ``horizon`` hours before, and the columns ``keep``.

    A device has one row an hour. What doesn't depend on the horizon is looked up before
    rows are multiplied by the horizons, and the trailing days of all possible origins are
    carried along, some 48 pairs of numbers a row: the multiplied rows are never shuffled.
    """
    names, at = [f"{target}_roll_24h_mean", f"{target}_roll_24h_std"], F.unix_timestamp("ts_hour")
    base = _seen(df, target, horizons, keep)
    base = base.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    base = base.withColumns({"origin": F.col("ts_hour") - clock.hours(F.col("horizon")), "_then": F.col("_seen")[at - F.col("horizon") * 3600]})
    told = _lag_columns(target, F.col("horizon"), parity) | {n: F.col(f"_then.{n}") for n in names}
    return base.withColumns(told).drop("_seen", "_then", *(f"_d{k}" for k in _DAYS))


def _packed_lags(df: DataFrame, target: str, horizons: Sequence[int], cfg: Config, parity: bool, keep: Sequence[str]) -> DataFrame:
    """The rows of ``train_lags``, one for each run of horizons that have all but the arrays in common."""
    at, runs = F.unix_timestamp("ts_hour"), packed.runs(horizons, cfg.bands)
    base = _seen(df, target, horizons, keep).withColumn("_h", F.explode(F.array(*[F.array(*map(F.lit, run)) for run in runs])))
    base = base.withColumns(_lag_columns(target, F.get("_h", F.lit(0)), parity)).withColumn("_then", F.transform("_h", lambda h: F.col("_seen")[at - h * 3600]))
    arrays = {"_m": F.col(f"_then.{target}_roll_24h_mean"), "_s": F.col(f"_then.{target}_roll_24h_std")}
    return base.withColumns(arrays).drop("_seen", "_then", *(f"_d{k}" for k in _DAYS))


def training_matrix(
    df: DataFrame, target: str, horizons: Sequence[int], cfg: Config, train_end: str | None = None, has_pv: bool = True, parity: bool = False, pack: bool = False
) -> DataFrame:
    """device_id, ts_hour, horizon, the target and its ordered features; rows without a target or after train_end go.

    With ``pack`` the horizons of a band are arrays in one row (``packed``), which least squares take as they are.
    """
    names = resolve_features(target, cfg, has_pv, df.columns)
    plain = [c for c in names if c in df.columns]
    if pack:
        inside = packed.varying(target)
        names = [*(c for c in names if c not in inside), *packed.ARRAYS]
        lags = _packed_lags(df, target, list(horizons), cfg, parity, plain).where(F.col(target).isNotNull())
    else:
        lags = train_lags(df, target, list(horizons), parity, plain).where(F.col(target).isNotNull())
    if train_end is not None:
        lags = lags.where(F.col("ts_hour") <= F.lit(train_end).cast("timestamp"))
    return lags.select("device_id", "ts_hour", target, *names)


def forecast_matrix(history: DataFrame, origins: DataFrame, target: str, cfg: Config, weather: DataFrame | None = None, has_pv: bool = True) -> DataFrame:
    """Features of the hours after each (device_id, origin); weather of the nearest hour, 0 without any."""
    steps = forecast_hours(origins.select("device_id", "origin"), cfg.horizon)
    names = resolve_features(target, cfg, has_pv, [*history.columns, *(weather.columns if weather is not None else ())])
    # the hours that lie whole days back are joined by equality; those after the origin are blanked
    out = _with_days(steps, history, target)
    out = out.withColumns({f"_d{k}": F.when(F.col("horizon") <= k * 24, F.col(f"_d{k}")) for k in _DAYS}).withColumns(_lag_columns(target, F.col("horizon"), False))
    out = _with_roll(out, history, target, "origin").withColumns(clock.calendar(F.col("ts_hour"), cfg.local_tz))
    needed = [c for c in names if c not in out.columns]
    if needed and weather is not None:
        out = nearest_join(out, weather, "ts_hour", "datetime", columns=[c for c in needed if c in weather.columns])
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) if c in out.columns else F.lit(0.0) for c in needed})
    return out.select("device_id", "origin", "ts_hour", *names)


def split_70_15_15(df: DataFrame, by: str = "device_id", order: str = "ts_hour") -> DataFrame:
    """Adds split: train, valid or test by each device's own row number, cut down to whole rows."""
    own = Window.partitionBy(by)
    n = F.count(F.lit(1)).over(own)
    rank = F.row_number().over(own.orderBy(order))
    kind = F.when(rank <= F.floor(n * F.lit(70) / 100), "train").when(rank <= F.floor(n * F.lit(85) / 100), "valid").otherwise("test")
    return df.withColumn("split", kind)


def time_split(df: DataFrame, fraction: float, by: Sequence[str] = ("device_id",), order: str = "ts_hour") -> DataFrame:
    """Adds is_validation: the latest rows beyond ``fraction`` of each group, cut by time so that one hour stays on one side."""
    own = Window.partitionBy(*by)
    df = df.withColumn("_rank", F.dense_rank().over(own.orderBy(order)))
    return df.withColumn("is_validation", F.col("_rank") > F.floor(F.max("_rank").over(own) * fraction)).drop("_rank")


def fit_log_scaler(df: DataFrame, value: str, by: str = "device_id") -> DataFrame:
    """Mean and population deviation of log1p(value); a deviation of 0 counts as 1."""
    scale = F.stddev_pop(F.log1p(value))
    return df.groupBy(by).agg(F.avg(F.log1p(value)).alias("log_mean"), F.when(scale > 0, scale).otherwise(1.0).alias("log_std"))


def log_standardize(df: DataFrame, scalers: DataFrame, value: str, by: str = "device_id") -> DataFrame:
    return df.join(scalers, by).withColumn(value, (F.log1p(value) - F.col("log_mean")) / F.col("log_std")).drop("log_mean", "log_std")


def inverse_log_standardize(df: DataFrame, scalers: DataFrame, value: str, by: str = "device_id") -> DataFrame:
    return df.join(scalers, by).withColumn(value, F.expm1(F.col(value) * F.col("log_std") + F.col("log_mean"))).drop("log_mean", "log_std")


def pool_state(df: DataFrame, target: str, context: int, horizon: int, train_end: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scalers, bounds of the 70-85 % band, dropped devices with the reason). The scalers see the first 70 % only."""
    if train_end is not None:
        df = df.where(F.col("ts_hour") <= F.lit(train_end).cast("timestamp"))
    df = split_70_15_15(df)
    train = F.when(F.col("split") == "train", F.log1p(target))
    valid = F.when(F.col("split") == "valid", F.col("ts_hour"))
    state = df.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(train).alias("log_mean"), F.stddev_pop(train).alias("log_std"), F.min(valid).alias("valid_start"), F.max(valid).alias("valid_end")
    )
    reason = (
        F.when(F.col("n") < context + horizon, "too few rows").when(F.col("valid_start").isNull(), "empty validation band").when(F.col("log_mean").isNull(), "no target in the training slice")
    )
    state = state.withColumn("reason", reason)
    kept = state.where("reason is null")
    scalers = kept.select("device_id", "log_mean", F.when(F.col("log_std") > 0, F.col("log_std")).otherwise(1.0).alias("log_std"))
    return scalers, kept.select("device_id", "valid_start", "valid_end"), state.where("reason is not null").select("device_id", "reason")


def gap_fill(df: DataFrame, value: str, by: str = "device_id", order: str = "ts_hour") -> DataFrame:
    """Last value, else next value, else 0."""
    # the next value is the last one of the reversed order: frames that only grow cost one step a row
    past, ahead = (Window.partitionBy(by).orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (order, F.desc(order)))
    return df.withColumn(value, F.coalesce(F.last(value, True).over(past), F.last(value, True).over(ahead), F.lit(0.0)))


def _series(df: DataFrame, target: str, covariates: Sequence[str], by: str, order: str, *more: str) -> DataFrame:
    """Each device's rows as one array in time order, _a (t, y, x and more), and their number _n."""
    # a struct keeps a null value in its place in the list
    row = F.struct(F.col(order).alias("t"), F.col(target).cast("double").alias("y"), F.array(*[F.col(c).cast("double") for c in covariates]).alias("x"), *more)
    return df.groupBy(by).agg(F.array_sort(F.collect_list(row)).alias("_a")).withColumn("_n", F.size("_a"))


def _windows(series: DataFrame, anchors: Column, context: int, horizon: int, covariates: Sequence[str], by: str) -> DataFrame:
    """One row an anchor (the number of the last context row, from 1): only the windows asked for are built."""
    past, future = (lambda i: F.slice("_a", i - context + 1, context)), (lambda i: F.slice("_a", i + 1, horizon))
    cut = F.transform(anchors, lambda i: F.struct(F.element_at("_a", i)["t"].alias("o"), past(i).alias("c"), future(i).alias("f")))
    df = series.select(by, F.explode(cut).alias("_w"))
    out = [by, F.col("_w.o").alias("origin"), F.col("_w.c.y").alias("ctx_target"), F.col("_w.f.y").alias("target")]
    return df.select(*out, *([F.col("_w.c.x").alias("ctx_cov"), F.col("_w.f.x").alias("future_cov")] if covariates else []))


def sequence_windows(df: DataFrame, target: str, context: int, horizon: int, stride: int, covariates: Sequence[str] = (), by: str = "device_id", order: str = "ts_hour") -> DataFrame:
    """Rolling windows as arrays: origin (time of the last context row), ctx_target, target, and ctx_cov and future_cov."""
    series = _series(df, target, covariates, by, order).where(F.col("_n") >= context + horizon)
    return _windows(series, F.sequence(F.lit(context), F.col("_n") - horizon, F.lit(stride)), context, horizon, covariates, by)


def supervised_windows(df: DataFrame, target: str, scalers: DataFrame, context: int, horizon: int, stride: int, split: str = "train") -> DataFrame:
    """Windows whose targets all lie in one split and are all there; contexts are scaled and gap-filled. Strides count from the first such window."""
    df = split_70_15_15(log_standardize(df, scalers, target).withColumn("_y", F.col(target)))
    own = Window.partitionBy("device_id").orderBy("ts_hour").rowsBetween(1, horizon)
    df = df.withColumn("ok", F.count(F.when(F.col("split") == split, F.col("_y"))).over(own) == horizon)
    series = _series(gap_fill(df, target), target, (), "device_id", "ts_hour", "ok").where(F.col("_n") >= context + horizon)
    series = series.withColumn("_ok", F.filter(F.sequence(F.lit(context), F.col("_n") - horizon), lambda i: F.element_at("_a", i)["ok"])).where(F.size("_ok") > 0)
    anchors = F.filter("_ok", lambda i: (i - F.element_at("_ok", 1)) % stride == 0)
    return _windows(series, anchors, context, horizon, (), "device_id")


def window_counts(lengths: DataFrame, context: int, horizon: int, stride: int, patch: int = 32, offset: int | None = None) -> DataFrame:
    """Numbers of training and validation windows of series of n_train and n_valid rows, and the context that fits all of them."""
    counts = lambda n, lead, step: F.greatest(F.lit(0), F.floor((F.col(n) - lead - horizon) / step) + 1).cast("long")
    fits = F.least(F.lit(context), F.col("_shortest") - horizon)
    shortest = lengths.agg(F.min("n_train").alias("_shortest"))  # one row
    return lengths.join(F.broadcast(shortest)).select(
        "device_id", counts("n_train", context, stride).alias("train_windows"), counts("n_valid", context if offset is None else offset, horizon).alias("valid_windows"),
        F.greatest(F.lit(0), F.floor(fits / patch) * patch).cast("long").alias("effective_context"),
    )


def finetune_series(df: DataFrame, target: str, scalers: DataFrame, min_rows: int, covariates: Sequence[str] = ()) -> DataFrame:
    """Each device's scaled series of the first 70 % and of the first 85 %, with the validation's offset; short ones go."""
    df = split_70_15_15(log_standardize(df, scalers, target))
    row = F.struct("ts_hour", F.col(target).alias("y"), F.array(*[F.col(c).cast("double") for c in covariates]).alias("x"))
    by = df.groupBy("device_id").agg(F.array_sort(F.collect_list(F.when(F.col("split") == "train", row))).alias("a"), F.array_sort(F.collect_list(F.when(F.col("split") != "test", row))).alias("b"))
    by = by.where(F.size("a") >= min_rows)
    out = [F.col("device_id"), F.col("a.y").alias("train"), F.col("b.y").alias("valid"), F.size("a").alias("offset")]
    return by.select(*out, *([F.col("a.x").alias("train_cov"), F.col("b.x").alias("valid_cov")] if covariates else []))


def context_and_future(df: DataFrame, origins: DataFrame, target: str, context: int, cfg: Config, weather: DataFrame | None = None, covariates: Sequence[str] = ()) -> DataFrame:
    """Each origin's last ``context`` rows and its future calendar and weather; origins with fewer rows go."""
    known = recent_rows(df, origins, context)
    past = known.groupBy("device_id", "origin").agg(F.array_sort(F.collect_list(F.struct("ts_hour", F.col(target).alias("y"), F.array(*[F.col(c).cast("double") for c in covariates]).alias("x")))).alias("_c"))
    past = past.where(F.size("_c") == context)
    future = forecast_hours(origins.select("device_id", "origin"), cfg.horizon).withColumns(clock.calendar(F.col("ts_hour"), cfg.local_tz))
    from_weather = [c for c in covariates if c not in future.columns]
    if from_weather and weather is not None:
        future = nearest_join(future, weather, "ts_hour", "datetime", columns=from_weather)
    future = future.withColumns({c: F.lit(0.0) for c in from_weather if c not in future.columns})
    ahead = future.groupBy("device_id", "origin").agg(F.array_sort(F.collect_list(F.struct("horizon", F.array(*[F.col(c).cast("double") for c in covariates]).alias("x")))).alias("_f"))
    return past.join(ahead, ["device_id", "origin"]).select("device_id", "origin", F.col("_c.y").alias("ctx_target"), F.col("_c.x").alias("ctx_cov"), F.col("_f.x").alias("future_cov"))

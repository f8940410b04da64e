"""From readings to the regular hourly table: rollup, targets, grid, gaps, weather, calendar, outliers.

All windows are over one device in time order, so one shuffle by device and one
sort serve them all; a device has a few thousand hours a year, and the fleet is
what grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..functions import clock
from ..functions.solar import clearsky_ghi, solar_position
from ..schema import SchemaError, utc
from .joins import by_device
from .validation import filter_start_date

GAP_COLUMNS = ("M1_cons", "M1_prod", "grid_import", "grid_export", "net_exchange")
#: Columns that may fall below zero.
SIGNED = ("net_exchange",)


def dedupe_readings(df: DataFrame, seq: str | None = None) -> DataFrame:
    """The last reading of each (device_id, ts): by ``seq`` if there is such a column, else the largest row, so that reruns agree."""
    rest = [c for c in df.columns if c not in ("device_id", "ts")]
    row = F.struct(*([seq, *[c for c in rest if c != seq]] if seq else rest))
    picked = df.groupBy("device_id", "ts").agg(F.max(row).alias("_r"))
    return picked.select(*(F.col(c) if c in ("device_id", "ts") else F.col(f"_r.{c}").alias(c) for c in df.columns))


def hourly_rollup(df: DataFrame, cfg: Config, quarters: int = 4) -> DataFrame:
    """Energy an hour. Hours with fewer than four readings are scaled up and marked; a sum of nulls alone is 0."""
    df = filter_start_date(df, cfg.start_date).where("device_id is not null and ts is not null")
    by = df.groupBy("device_id", F.date_trunc("hour", "ts").alias("ts_hour")).agg(
        F.coalesce(F.sum("consumption_kwh"), F.lit(0.0)).alias("c"), F.coalesce(F.sum("production_kwh"), F.lit(0.0)).alias("p"), F.count(F.lit(1)).alias("n_quarters")
    )
    partial = F.col("n_quarters") < quarters
    scale = F.when(partial, F.lit(float(quarters)) / F.col("n_quarters")).otherwise(1.0)
    return by.select("device_id", "ts_hour", (F.col("c") * scale).alias("M1_cons"), (F.col("p") * scale).alias("M1_prod"), "n_quarters", partial.alias("partial_hour"))


def derive_targets(df: DataFrame, cfg: Config) -> DataFrame:
    """grid_import, grid_export (noise and negatives are 0, null stays null) and net_exchange."""
    clean = lambda c: F.when(F.col(c).isNull(), None).when(F.col(c) < cfg.noise_floor_kwh, 0.0).otherwise(F.col(c))
    df = df.withColumns({"grid_import": clean("M1_cons"), "grid_export": clean("M1_prod")})
    return df.withColumn("net_exchange", F.col("grid_export") - F.col("grid_import"))


def regular_grid(df: DataFrame) -> DataFrame:
    """Every device at every hour between the first and the last of all. The two bounds are one row."""
    bounds = df.agg(F.min("ts_hour").alias("a"), F.max("ts_hour").alias("b")).where("a is not null")
    devices = df.select("device_id").distinct()
    grid = devices.join(F.broadcast(bounds)).select("device_id", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("ts_hour"))
    return grid.join(df, ["device_id", "ts_hour"], "left")


def interpolate_gaps(df: DataFrame, columns: Sequence[str] = GAP_COLUMNS, limit: int = 1) -> DataFrame:
    """Linear interpolation of the first ``limit`` hours of each gap; a gap that never ends takes the last value, one at the start stays.

    Sums fall below zero only by rounding, so all but net_exchange are held at 0.
    """
    own = Window.partitionBy("device_id")
    # what comes next is the last of the reversed order: frames that only grow cost one step a row
    past, ahead = (own.orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow) for o in ("ts_hour", F.desc("ts_hour")))
    df = df.withColumn("_i", F.row_number().over(own.orderBy("ts_hour")))
    out = {}
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col("_i"))
        before, after = F.last(c, True).over(past), F.last(c, True).over(ahead)
        i, j = F.last(at, True).over(past), F.last(at, True).over(ahead)
        line = F.when(after.isNull(), before).otherwise(before + (after - before) * (F.col("_i") - i) / (j - i))
        fill = F.when(F.col(c).isNotNull(), F.col(c)).when(F.col("_i") - i <= limit, line)
        out[c] = fill if c in SIGNED else clock.at_least(fill, 0.0)
    return df.withColumns(out).drop("_i")


def gap_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("gap_flag", F.col("M1_cons").isNull() | F.col("M1_prod").isNull())


def prepare_weather(df: DataFrame, cfg: Config, tz: str | None = None, site: str | None = None) -> DataFrame:
    """One row an hour (and site) in UTC with ghi_ramp, the change of irradiance since the hour before.

    Times without a zone are wall times in ``tz``, the fleet's own by default: an
    hour that occurs twice is left out, one that the clock skips moves to the change.
    """
    utc(df.sparkSession)
    kind, local = df.schema["datetime"].dataType, tz or cfg.local_tz
    if isinstance(kind, T.StringType):
        wall = F.try_to_timestamp("datetime")
        at = F.when(clock.has_zone(F.col("datetime")), wall).otherwise(clock.localize_utc(wall, local))
    elif isinstance(kind, T.TimestampType) and tz is None:
        at = F.col("datetime")  # an instant already
    else:
        at = clock.localize_utc(F.col("datetime").cast("timestamp"), local)
    df = df.withColumn("datetime", at).where("datetime is not null")
    keys = ([site] if site else []) + ["datetime"]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*(rest or [F.lit(0)]))
    df = df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    if "global_tilted_irradiance" in df.columns:
        # one site's hours are a few thousand rows a year; with many sites they are dealt by site
        order = Window.partitionBy(*([site] if site else [F.lit(0)])).orderBy("datetime")
        ramp = F.col("global_tilted_irradiance") - F.lag("global_tilted_irradiance").over(order)
        df = df.withColumn("ghi_ramp", F.coalesce(ramp, F.lit(0.0)))
    return df


def weather_features(raw: DataFrame, lat: float | str, lon: float | str, cfg: Config, site: str | None = None) -> DataFrame:
    """The twelve weather features of the models from raw hourly weather."""
    if missing := [c for c in ("datetime", "temperature_2m", "cloud_cover", "shortwave_radiation") if c not in raw.columns]:
        raise SchemaError(f"missing column(s): {', '.join(missing)}")
    df = solar_position(raw.withColumn("datetime", F.col("datetime").cast("timestamp")), "datetime", lat, lon)
    zero = lambda c: F.coalesce(clock.not_nan(F.col(c).cast("double")), F.lit(0.0))
    clear, temperature = clearsky_ghi(F.col("cos_zenith")), clock.not_nan(F.col("temperature_2m").cast("double"))
    order = Window.partitionBy(*([site] if site else [F.lit(0)])).orderBy("datetime")
    cloud = clock.not_nan(F.col("cloud_cover").cast("double"))
    day = (zero("is_day") > 0) if "is_day" in raw.columns else F.col("solar_elevation") > 0
    index = F.when(clear > 1.0, F.greatest(F.lit(0.0), F.least(F.lit(1.2), zero("shortwave_radiation") / clear))).otherwise(0.0)
    return df.select(
        *([site] if site else []),
        "datetime",
        zero("global_tilted_irradiance" if "global_tilted_irradiance" in raw.columns else "shortwave_radiation").alias("global_tilted_irradiance"),
        zero("shortwave_radiation").alias("shortwave_radiation"),
        zero("cloud_cover").alias("cloud_cover"),
        temperature.alias("temperature_2m"),
        index.alias("clearsky_index"),
        F.col("cos_zenith").alias("effective_solar_pv"),
        clock.at_least(F.lit(cfg.heating_base_c) - temperature, 0.0).alias("heating_degree"),
        clock.at_least(temperature - cfg.cooling_base_c, 0.0).alias("cooling_degree"),
        day.cast("int").alias("is_daylight"),
        F.greatest("solar_elevation", F.lit(0.0)).alias("solar_elevation"),
        F.coalesce(cloud - F.lag(cloud).over(order), F.lit(0.0)).alias("cloud_cover_diff"),
        (1.0 - cfg.pv_temp_coeff * clock.at_least(temperature - cfg.pv_temp_ref_c, 0.0)).alias("pv_temp_factor"),
    )


def weather_for_sites(raw: DataFrame, sites: DataFrame, cfg: Config) -> DataFrame:
    """weather_features at each site (site_id, latitude, longitude); sites without a place are left out."""
    placed = sites.where("latitude is not null and longitude is not null").select("site_id", "latitude", "longitude")
    return weather_features(raw.join(placed, "site_id"), "latitude", "longitude", cfg, site="site_id")


def merge_weather_hourly(grid: DataFrame, weather: DataFrame, site: str | None = None) -> DataFrame:
    """Weather of the same hour (and site). Spark broadcasts the weather as long as it measures it to be small."""
    weather = weather.withColumnRenamed("datetime", "ts_hour")
    return grid.join(weather, [*([site] if site else []), "ts_hour"], "left")


def calendar_features(df: DataFrame, tz: str) -> DataFrame:
    """Local calendar, and with weather theoretical_prod (irradiance times availability) and a plain is_daylight."""
    df = df.withColumns(clock.calendar(F.col("ts_hour"), tz))
    if {"global_tilted_irradiance", "effective_solar_pv"} <= set(df.columns):
        df = df.withColumn("theoretical_prod", F.coalesce(F.col("global_tilted_irradiance") * F.col("effective_solar_pv"), F.lit(0.0)))
    if "is_daylight" in df.columns:
        df = df.withColumn("is_daylight", F.coalesce(F.col("is_daylight").cast("int"), F.lit(0)))
    return df


def outlier_flags(df: DataFrame, cfg: Config) -> DataFrame:
    """grid_*_outlier: further than three deviations from the mean of the week around."""
    half = cfg.outlier_window_hours // 2
    around = Window.partitionBy("device_id").orderBy("ts_hour").rowsBetween(-half, cfg.outlier_window_hours - half - 1)

    def flag(c: str) -> Column:
        distance = F.abs(F.col(c) - F.avg(c).over(around)) / (F.stddev_samp(c).over(around) + 1e-6)
        return F.coalesce((F.count(c).over(around) >= cfg.outlier_min_periods) & (distance > cfg.outlier_zscore), F.lit(False))

    return df.withColumns({f"{c}_outlier": flag(c) for c in ("grid_export", "grid_import")})


def processed_hourly(meters: DataFrame, cfg: Config, weather: DataFrame | None = None, seq: str | None = None) -> DataFrame:
    """The regular hourly table of all devices, as one lazy plan."""
    grid = regular_grid(derive_targets(hourly_rollup(dedupe_readings(meters, seq), cfg), cfg).drop("n_quarters"))
    grid = gap_flag(interpolate_gaps(by_device(grid), limit=cfg.max_gap_hours))
    if weather is not None:
        grid = merge_weather_hourly(grid, prepare_weather(weather, cfg))
    return outlier_flags(calendar_features(grid, cfg.local_tz), cfg)

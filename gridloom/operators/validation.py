"""Contracts, data sufficiency, and the filters that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import WEATHER_COLUMNS, Config
from ..schema import METER_SCHEMA, SchemaError


def validate(df: DataFrame, kind: str = "meter") -> DataFrame:
    """The frame itself, if it keeps its contract; SchemaError names the column that doesn't."""
    need = METER_SCHEMA.names if kind == "meter" else ["datetime"]
    if missing := [c for c in need if c not in df.columns]:
        raise SchemaError(f"missing column(s): {', '.join(missing)}")
    if kind == "meter":
        if not isinstance(df.schema["ts"].dataType, T.TimestampType):
            raise SchemaError("ts: expected an instant (timestamp with a time zone)")
        for c in METER_SCHEMA.names[2:]:
            if not isinstance(df.schema[c].dataType, T.NumericType):
                raise SchemaError(f"{c}: expected numbers")
        if df.isEmpty():
            raise SchemaError("device_id: no rows")
    return df


def missing_weather(df: DataFrame) -> list[str]:
    """Recommended weather columns that are absent; a model goes without them."""
    return [c for c in WEATHER_COLUMNS if c not in df.columns]


def assess_sufficiency(df: DataFrame, cfg: Config) -> DataFrame:
    """device_id, energy_rows, span_days, coverage, eligible, reason."""
    has = F.coalesce(*[F.when(F.col(t).isNotNull(), F.lit(True)) for t in cfg.targets], F.lit(False))
    seconds = F.unix_timestamp(F.when(has, F.col("ts_hour")))
    by = df.groupBy("device_id").agg(F.count_if(has).alias("energy_rows"), F.min(seconds).alias("first"), F.max(seconds).alias("last"))
    span = F.when(F.col("energy_rows") >= 2, (F.col("last") - F.col("first")) / 86400.0).otherwise(0.0)
    by = by.withColumn("span_days", span)
    by = by.withColumn("coverage", F.when(F.col("energy_rows") >= 2, F.col("energy_rows") / F.greatest(F.col("span_days") * 24, F.lit(1.0))).otherwise(0.0))
    short, thin = F.col("span_days") < cfg.span_needed, F.col("coverage") < cfg.min_coverage
    reason = F.concat_ws(
        "; ",
        F.when(short, F.format_string("span %.1f d < %.1f d", F.col("span_days"), F.lit(float(cfg.span_needed)))),
        F.when(thin, F.format_string("coverage %.2f < %.2f", F.col("coverage"), F.lit(float(cfg.min_coverage)))),
    )
    out = by.select("device_id", "energy_rows", F.bround("span_days", 4).alias("span_days"), F.bround("coverage", 4).alias("coverage"), (~short & ~thin).alias("eligible"), reason.alias("reason"))
    return out.withColumn("reason", F.when(F.col("eligible"), F.lit("ok")).otherwise(F.col("reason")))


def require_eligible(verdicts: DataFrame) -> DataFrame:
    """The eligible devices; an error if there is none."""
    some = verdicts.where("eligible")
    if some.isEmpty():
        raise SchemaError("no device has enough data")
    return some


def activity_gates(df: DataFrame, cfg: Config) -> DataFrame:
    """device_id, mean_export, mean_import, export_eligible, import_eligible."""
    by = df.groupBy("device_id").agg(F.avg("grid_export").alias("mean_export"), F.avg("grid_import").alias("mean_import"))
    return by.withColumns({
        "export_eligible": F.coalesce(F.col("mean_export") >= cfg.export_min_mean_kwh, F.lit(False)),
        "import_eligible": F.coalesce(F.col("mean_import") >= cfg.import_min_mean_kwh, F.lit(False)),
    })


def filter_start_date(df: DataFrame, start_date: str | None, time: str = "ts") -> DataFrame:
    return df if start_date is None else df.where(F.col(time) >= F.lit(start_date).cast("timestamp"))


def remove_outliers(df: DataFrame) -> DataFrame:
    return df.where(~(F.coalesce("grid_export_outlier", F.lit(False)) | F.coalesce("grid_import_outlier", F.lit(False))))


def recent_window(df: DataFrame, days: int, time: str = "ts_hour") -> DataFrame:
    """Rows of the last ``days`` days before the newest row of all. The newest time is one row, and is joined as such."""
    newest = df.agg(F.max(time).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(time) >= F.col("_newest") - F.make_dt_interval(F.lit(days))).drop("_newest")


def target_gate(gates: DataFrame) -> DataFrame:
    """(device_id, target) pairs that are modelled."""
    long = gates.selectExpr("device_id", "stack(2, 'grid_export', export_eligible, 'grid_import', import_eligible) AS (target, allowed)")
    return long.where("allowed").select("device_id", "target")


def only_devices(df: DataFrame, devices: DataFrame) -> DataFrame:
    return df.join(devices.select("device_id"), "device_id", "left_semi")


def exclude_devices(df: DataFrame, devices: DataFrame) -> DataFrame:
    return df.join(devices.select("device_id"), "device_id", "left_anti")


def resolve_features(target: str, cfg: Config, has_pv: bool = True, columns: Sequence[str] | None = None) -> list[str]:
    """Ordered inputs of a target's model: calendar, the weather that there is, lags, horizon."""
    key = target if target != "grid_import" else "grid_import_pv" if has_pv else "grid_import_no_pv"
    weather = [w for w in cfg.weather_by_target.get(key, ()) if columns is None or w in columns]
    return [*cfg.calendar, *weather, *(f"{target}_{lag}" for lag in cfg.lags), "horizon"]


def resolve_covariates(target: str, cfg: Config, has_pv: bool = True, columns: Sequence[str] | None = None) -> list[str]:
    """Covariates of a sequence model: weather, then calendar, each once."""
    key = target if target != "grid_import" else "grid_import_pv" if has_pv else "grid_import_no_pv"
    weather = [w for w in cfg.weather_by_target.get(key, ()) if columns is None or w in columns]
    return list(dict.fromkeys([*weather, *cfg.calendar]))

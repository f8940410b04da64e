"""Sources: files, tables, several feeds of the same readings, and weather payloads."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import has_zone, localize_utc, not_nan
from ..operators.validation import validate
from ..schema import SchemaError, utc

_TABLE, _COLUMN = re.compile(r"[a-zA-Z_][\w.]*"), re.compile(r"[a-zA-Z_]\w*")

#: Other names under which feeds deliver the contract's columns, matched without case.
ALIASES: dict[str, tuple[str, ...]] = {
    "device_id": ("device_id", "device", "meter_id", "meter", "serial", "id", "pod", "pdr"),
    "ts": ("ts", "timestamp", "time", "datetime", "date", "ts_utc", "reading_time", "interval_start", "data"),
    "consumption_kwh": (
        "consumption_kwh", "consumption_kw", "consumption", "cons", "import", "grid_import", "kwh_in", "energy_in",
        "active_energy_import", "prelievo", "consumo",
    ),
    "production_kwh": (
        "production_kwh", "production_kw", "production", "prod", "export", "grid_export", "kwh_out", "energy_out",
        "active_energy_export", "immissione", "produzione",
    ),
}


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by extension. CSV columns arrive as strings; the contract's types come later, without a second scan."""
    kind = path.rstrip("/").lower().rpartition(".")[2]
    if kind in ("parquet", "pq"):
        return utc(spark).read.parquet(path)
    if kind == "csv":
        return utc(spark).read.option("header", True).csv(path)
    raise ValueError(f"{path}: expected .parquet, .pq or .csv")


def rename_map(columns: Sequence[str]) -> dict[str, str]:
    """Delivered name -> contract name. A contract name that is there stays; else the first alias from the left counts."""
    found: dict[str, str] = {}
    for target, names in ALIASES.items():
        if target in columns:
            continue
        match = next((c for c in columns if c.strip().lower() in names and c not in found and c not in ALIASES), None)
        if match is not None:
            found[match] = target
    return found


def normalize_meters(df: DataFrame, assume_tz: str | None = None, column_map: Mapping[str, str] | None = None) -> DataFrame:
    """Contract names and types. Times without a zone are read as wall time in assume_tz (UTC if none); unreadable ones become null."""
    utc(df.sparkSession)
    df = df.withColumnsRenamed(dict(column_map or {}))
    df = df.withColumnsRenamed(rename_map(df.columns))
    if "ts" in df.columns:
        kind = df.schema["ts"].dataType
        if isinstance(kind, T.StringType):
            zoned = has_zone(F.col("ts"))
            at = F.try_to_timestamp("ts")
            df = df.withColumn("ts", F.when(zoned, at).otherwise(localize_utc(at, assume_tz) if assume_tz else at))
        elif isinstance(kind, T.TimestampType):
            pass  # an instant already
        else:
            at = F.col("ts").cast("timestamp")
            df = df.withColumn("ts", localize_utc(at, assume_tz) if assume_tz else at)
    energies = [c for c in ("consumption_kwh", "production_kwh") if c in df.columns and df.schema[c].dataType != T.DoubleType()]
    df = df.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in energies})
    df = df.withColumns({c: not_nan(F.col(c)) for c in ("consumption_kwh", "production_kwh") if c in df.columns})
    return df.withColumn("device_id", F.col("device_id").cast("string")) if "device_id" in df.columns else df


def load_meters(spark: SparkSession, path: str, normalize: bool = True, assume_tz: str | None = None, column_map: Mapping[str, str] | None = None) -> DataFrame:
    df = read_any(spark, path)
    return validate(normalize_meters(df, assume_tz, column_map) if normalize else df)


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    return validate(read_any(spark, path), kind="weather")


def _jdbc_table(spark: SparkSession, table: str, jdbc: Mapping[str, str], split: str | None, connections: int) -> DataFrame:
    source = spark.read.format("jdbc").options(**jdbc)
    if split is None:
        return source.option("dbtable", table).load()
    if not _COLUMN.fullmatch(split):
        raise ValueError(f"not a column name: {split!r}")
    low, high = source.option("query", f"SELECT MIN({split}) AS a, MAX({split}) AS b FROM {table}").load().first()
    source = spark.read.format("jdbc").options(**jdbc, dbtable=table)
    if low is None:  # no rows, or none that has it
        return source.load()
    return source.options(partitionColumn=split, lowerBound=str(low), upperBound=str(high), numPartitions=str(connections)).load()


def read_table(
    spark: SparkSession, table: str, filters: Mapping[str, object] | None = None, device_ids: Sequence[str] | None = None,
    jdbc: Mapping[str, str] | None = None, column_map: Mapping[str, str] | None = None, split: str | None = None, connections: int = 8,
) -> DataFrame:
    """A catalog or JDBC table with equality and IN filters, which Catalyst hands to the source. Devices are filtered after renaming.

    ``split`` names a number, date or time column of a JDBC table: its range, which one query
    asks the database for, is cut into ``connections`` parts that are read side by side, and
    no more than so many connections are open. Rows without it are in the first part.
    """
    if not _TABLE.fullmatch(table):
        raise ValueError(f"not a table name: {table!r}")
    utc(spark)
    df = _jdbc_table(spark, table, jdbc, split, connections) if jdbc else spark.table(table)
    for column, wanted in (filters or {}).items():
        if not _COLUMN.fullmatch(column):
            raise ValueError(f"not a column name: {column!r}")
        many = isinstance(wanted, list | tuple | set)
        df = df.where(F.col(column).isin(list(wanted)) if many else F.col(column) == F.lit(wanted))
    df = df.withColumnsRenamed(dict(column_map or {}))
    return df.where(F.col("device_id").isin(list(device_ids))) if device_ids is not None else df


def first_of(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row a key: the one of the first frame that has the key, and within a frame the smallest row."""
    if not frames:
        raise SchemaError("no source holds any rows")
    tagged = [f.withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)]
    both = tagged[0]
    for frame in tagged[1:]:
        both = both.unionByName(frame, allowMissingColumns=True)
    rest = [F.col(c) for c in both.columns if c not in {*keys, "_prio"}]
    order = Window.partitionBy(*keys).orderBy("_prio", *(c.asc_nulls_last() for c in rest))
    return both.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_prio")


def merge_sources(sources: Sequence[tuple[DataFrame, Mapping[str, str] | None, str | None]]) -> DataFrame:
    """Readings of several feeds, (frame, column map, zone of local times) in order of priority."""
    frames = [normalize_meters(df, tz, columns) for df, columns, tz in sources]
    merged = first_of(frames, ["device_id", "ts"])
    if all(f.isEmpty() for f in frames):
        raise SchemaError("no source holds any rows")
    return merged


def merge_weather(sources: Sequence[tuple[DataFrame, Mapping[str, str] | None]]) -> DataFrame:
    """Weather of several feeds; the first one that has an hour counts for it."""
    return first_of([df.withColumnsRenamed(dict(columns or {})) for df, columns in sources], ["datetime"])


def hourly_payload_to_rows(payloads: DataFrame, column: str = "hourly") -> DataFrame:
    """Payloads whose ``hourly`` struct holds parallel arrays -> one row an hour. No time array, no rows."""
    kind = payloads.schema[column].dataType if column in payloads.columns else None
    if not isinstance(kind, T.StructType) or "time" not in kind.names:
        return payloads.sparkSession.createDataFrame([], "datetime timestamp")
    rows = payloads.select(F.inline(F.arrays_zip(*(F.col(f"{column}.{n}").alias(n) for n in kind.names))))
    rows = rows.where("time is not null").withColumn("datetime", F.try_to_timestamp(F.col("time").cast("string")))
    return rows.select("datetime", *(F.col(n).cast("double").alias(n) for n in kind.names if n != "time"))


def stitch_archive_forecast(archive: DataFrame, forecast: DataFrame, start: str, end: str) -> DataFrame:
    """Archive and forecast hours in [start, end]; where both have an hour, the forecast counts."""
    inside = F.col("datetime").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return first_of([forecast.where(inside), archive.where(inside)], ["datetime"])


def meter_of(user_id: Column, users: int = 20) -> Column:
    """The meter of a user: each ``users`` consecutive ones share one, so meters grow with the users."""
    return F.concat(F.lit("dev-"), F.floor(user_id / users).cast("string"))


def meters_from_events(events: DataFrame, users: int = 20) -> DataFrame:
    """Readings from an event log: ``users`` share a meter, values count as energy by event type, in 15-minute slots."""
    utc(events.sparkSession)
    takes = F.col("event_type").isin("click", "view", "signup")
    gives = F.col("event_type").isin("purchase", "error")
    slot = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 900) * 900)
    return events.groupBy(meter_of(F.col("user_id"), users).alias("device_id"), slot.alias("ts")).agg(
        F.sum(F.when(takes, F.col("value")).otherwise(0.0)).alias("consumption_kwh"),
        F.sum(F.when(gives, F.col("value")).otherwise(0.0)).alias("production_kwh"),
    )

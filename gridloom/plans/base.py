"""What the registered queries share: the derived meter and weather tables, in Spark and as SQL."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..operators import cleaning
from ..operators.joins import by_device
from ..schema import utc
from ..sources.readers import meter_of, meters_from_events

#: So many consecutive users share a meter.
USERS = 20
#: The events span 30 days.
CFG = Config(min_span_days=14.0)
#: Where the weather that all meters share was measured: latitude, longitude.
PLACE = (46.07, 11.12)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clear
        pass


_MADE: list[tuple[SparkSession, str]] = []
_OWN: list[str] = []


@contextmanager
def scratch():
    """Tables that queries store inside go when it ends; the others when the interpreter does."""
    begin = len(_MADE)
    try:
        yield
    finally:
        while len(_MADE) > begin:
            _drop(*_MADE.pop())


def _drop_all() -> None:
    while _MADE:
        _drop(*_MADE.pop())


atexit.register(_drop_all)


def fresh_path(spark: SparkSession, suffix: str = "") -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir; one of our own where none is named)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="gridloom-"))
        shared = _OWN[0]
    path = f"{shared.rstrip('/')}/gridloom-{uuid.uuid4().hex}{suffix}"
    _MADE.append((spark, path))
    return path


def stored(df: DataFrame) -> DataFrame:
    """A table that several steps use, written in the shared folder and read again.

    Device tables are dealt by device first: what is small when it is written, and so one
    file, may be multiplied by horizons and origins when it is read.
    """
    path = fresh_path(df.sparkSession)
    if "device_id" in df.columns:
        df = by_device(df)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meters_from_events(table(spark, sf_dir, "events"), USERS)


def rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.derive_targets(cleaning.hourly_rollup(meters(spark, sf_dir), CFG), CFG)


def _events_by_hour(spark: SparkSession, sf_dir: str, *keys: Column) -> DataFrame:
    """Views and errors as shares of an hour's events."""
    kind = F.col("event_type")
    share = lambda k: F.count_if(kind == k) / F.count(F.lit(1))
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy(*keys, hour.alias("datetime")).agg(share("view").alias("views"), share("error").alias("errors"))


def _span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the first and the last hour."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").agg(F.min(hour).alias("a"), F.max(hour).alias("b"))


def _readings() -> list[Column]:
    """Closed forms of the hour, moved by what happened in it."""
    hour, day = F.hour("datetime"), F.dayofmonth("datetime")
    views, errors = F.coalesce("views", F.lit(0.0)), F.coalesce("errors", F.lit(0.0))
    return [
        (10 + 8 * F.sin((hour - 9) * (2 * math.pi / 24)) + 5 * errors).alias("temperature_2m"),
        (20.0 + 5.0 * (day % 10) + 30 * views).alias("cloud_cover"),
        (F.lit(700.0) * F.greatest(F.lit(0.0), F.sin((hour - 6) * (math.pi / 12))) * (1 - 0.3 * views)).alias("shortwave_radiation"),
    ]


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather over the events' time."""
    hours = _span(spark, sf_dir).select(F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("datetime"))
    return hours.join(_events_by_hour(spark, sf_dir), "datetime", "left").select("datetime", *_readings())


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site for each meter."""
    user = F.col("user_id")
    number = F.floor(user / USERS)
    where = [(36 + number % 11).cast("double").alias("latitude"), (7 + number % 12).cast("double").alias("longitude")]
    return table(spark, sf_dir, "events").select(meter_of(user, USERS).alias("site_id"), *where).distinct()


def sited_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather of each site, with its place; the span joined to each is one row."""
    hours = sites(spark, sf_dir).crossJoin(F.broadcast(_span(spark, sf_dir))).select(
        "site_id", "latitude", "longitude", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("datetime"))
    seen = _events_by_hour(spark, sf_dir, meter_of(F.col("user_id"), USERS).alias("site_id"))
    return hours.join(seen, ["site_id", "datetime"], "left").select("site_id", "latitude", "longitude", "datetime", *_readings())


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.weather_features(raw_weather(spark, sf_dir), *PLACE, CFG)


def hourly(spark: SparkSession, sf_dir: str, with_weather: bool = False) -> DataFrame:
    return cleaning.processed_hourly(meters(spark, sf_dir), CFG, weather(spark, sf_dir) if with_weather else None)


def rounded(x: Column | str, digits: int) -> Column:
    """A double multiplied by a power of ten, rounded and divided again, as DuckDB rounds: Spark's round(x, digits) takes halves by the shortest decimals of x."""
    x, ten = F.col(x) if isinstance(x, str) else x, 10.0**digits
    # what becomes infinite has no decimals
    return F.when(F.abs(x * ten) < float("inf"), F.round(x * ten) / ten).otherwise(x)


def out(df: DataFrame) -> DataFrame:
    """Six decimals, no negative zero, and timestamps without a zone, as the SQL gives them."""
    fixed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            fixed[f.name] = rounded(F.col(f.name).cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            fixed[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(fixed) if fixed else df


# ------------------------------------------------------------------ SQL

METERS = f"""
meters AS (
  SELECT 'dev-' || CAST(user_id // {USERS} AS VARCHAR) AS device_id, time_bucket(INTERVAL 15 MINUTE, ts) AS ts,
    sum(CASE WHEN event_type IN ('click', 'view', 'signup') THEN value ELSE 0 END) AS consumption_kwh,
    sum(CASE WHEN event_type IN ('purchase', 'error') THEN value ELSE 0 END) AS production_kwh
  FROM events GROUP BY ALL
)"""
ROLLED = METERS + """, sums AS (
  SELECT device_id, date_trunc('hour', ts) AS ts_hour, sum(consumption_kwh) AS c, sum(production_kwh) AS p, count(*) AS n_quarters
  FROM meters GROUP BY ALL
), rolled AS (
  SELECT device_id, ts_hour, n_quarters, n_quarters < 4 AS partial_hour,
    c * CASE WHEN n_quarters < 4 THEN CAST(4 AS DOUBLE) / n_quarters ELSE 1.0 END AS M1_cons,
    p * CASE WHEN n_quarters < 4 THEN CAST(4 AS DOUBLE) / n_quarters ELSE 1.0 END AS M1_prod
  FROM sums
), targets AS (
  SELECT *, CASE WHEN M1_cons < 0.02 THEN 0.0 ELSE M1_cons END AS grid_import, CASE WHEN M1_prod < 0.02 THEN 0.0 ELSE M1_prod END AS grid_export,
    CASE WHEN M1_prod < 0.02 THEN 0.0 ELSE M1_prod END - CASE WHEN M1_cons < 0.02 THEN 0.0 ELSE M1_cons END AS net_exchange
  FROM rolled
)"""
GRID = ROLLED + """, bounds AS (SELECT min(ts_hour) AS a, max(ts_hour) AS b FROM targets
), hours AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts_hour FROM bounds
), grid AS (
  SELECT d.device_id, h.ts_hour, M1_cons, M1_prod, partial_hour, grid_import, grid_export, net_exchange
  FROM (SELECT DISTINCT device_id FROM targets) d CROSS JOIN hours h LEFT JOIN targets t ON t.device_id = d.device_id AND t.ts_hour = h.ts_hour
)"""


def _filled(c: str) -> str:
    line = f"CASE WHEN {c}_n IS NULL THEN {c}_p ELSE {c}_p + ({c}_n - {c}_p) * (i - i_p) / (i_n - i_p) END"
    low = line if c == "net_exchange" else f"greatest({line}, 0.0)"
    return f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN i - i_p <= 1 THEN {low} END AS {c}"


_GAPS = ("M1_cons", "M1_prod", "grid_import", "grid_export", "net_exchange")
HOURLY = GRID + f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS i FROM grid
), beside AS (
  SELECT *, last_value(CASE WHEN M1_cons IS NOT NULL THEN i END IGNORE NULLS) OVER p AS i_p, first_value(CASE WHEN M1_cons IS NOT NULL THEN i END IGNORE NULLS) OVER n AS i_n,
    {', '.join(f'last_value({c} IGNORE NULLS) OVER p AS {c}_p, first_value({c} IGNORE NULLS) OVER n AS {c}_n' for c in _GAPS)}
  FROM numbered
  WINDOW p AS (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (SELECT device_id, ts_hour, partial_hour, {', '.join(_filled(c) for c in _GAPS)} FROM beside
), local AS (
  SELECT *, M1_cons IS NULL OR M1_prod IS NULL AS gap_flag, (ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome' AS here FROM filled
), calendar AS (
  SELECT *, CAST(hour(here) AS INTEGER) AS hour_local, CAST(isodow(here) - 1 AS INTEGER) AS day_of_week, CAST(month(here) AS INTEGER) AS month,
    CAST(isodow(here) >= 6 AS INTEGER) AS is_weekend, sin(2 * pi() * hour(here) / 24) AS hour_sin, cos(2 * pi() * hour(here) / 24) AS hour_cos
  FROM local
), hourly AS (
  SELECT * EXCLUDE (here),
    coalesce(count(grid_export) OVER w >= 24 AND abs(grid_export - avg(grid_export) OVER w) / (stddev_samp(grid_export) OVER w + 1e-6) > 3, false) AS grid_export_outlier,
    coalesce(count(grid_import) OVER w >= 24 AND abs(grid_import - avg(grid_import) OVER w) / (stddev_samp(grid_import) OVER w + 1e-6) > 3, false) AS grid_import_outlier
  FROM calendar
  WINDOW w AS (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING)
)"""
_SHARES = "count(*) FILTER (WHERE event_type = 'view') / count(*) AS views, count(*) FILTER (WHERE event_type = 'error') / count(*) AS errors"
_READINGS = """10 + 8 * sin(2 * pi() * (hour(datetime) - 9) / 24) + 5 * coalesce(errors, 0) AS temperature_2m,
    CAST(20 + 5 * (day(datetime) % 10) AS DOUBLE) + 30 * coalesce(views, 0) AS cloud_cover,
    700 * greatest(0.0, sin(pi() * (hour(datetime) - 6) / 12)) * (1 - 0.3 * coalesce(views, 0)) AS shortwave_radiation"""
WEATHER = f"""
wspan AS (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events
), whours AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS datetime FROM wspan
), wseen AS (SELECT date_trunc('hour', ts) AS h, {_SHARES} FROM events GROUP BY 1
), raw_weather AS (SELECT datetime, {_READINGS} FROM whours LEFT JOIN wseen ON h = datetime
)"""
#: placed: the weather of each site.
PLACED = f"""{WEATHER}, sites AS (
  SELECT DISTINCT 'dev-' || CAST(user_id // {USERS} AS VARCHAR) AS site_id, CAST(36 + user_id // {USERS} % 11 AS DOUBLE) AS latitude,
    CAST(7 + user_id // {USERS} % 12 AS DOUBLE) AS longitude FROM events
), sseen AS (SELECT 'dev-' || CAST(user_id // {USERS} AS VARCHAR) AS site, date_trunc('hour', ts) AS h, {_SHARES} FROM events GROUP BY 1, 2
), placed AS (
  SELECT site_id, latitude, longitude, datetime, {_READINGS} FROM sites CROSS JOIN whours LEFT JOIN sseen ON site = site_id AND h = datetime
)"""


def sun(source: str, lat: str, lon: str) -> str:
    """CTEs sunny: source with cos_z in [-1, 1]."""
    return f"""
angles AS (SELECT *, 2 * pi() / 365 * (dayofyear(datetime) - 1 + (hour(datetime) + minute(datetime) / 60.0 - 12) / 24) AS g FROM {source}
), bent AS (
  SELECT *, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS decl,
    229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq
  FROM angles
), sunny AS (
  SELECT * EXCLUDE (g, decl, eq), greatest(-1.0, least(1.0, sin(radians({lat})) * sin(decl) + cos(radians({lat})) * cos(decl)
    * cos(radians((hour(datetime) * 60.0 + minute(datetime) + eq + 4 * {lon}) / 4 - 180)))) AS cos_z
  FROM bent
), clear AS (
  SELECT *, CASE WHEN cos_z > 0 THEN 1098.0 * cos_z * exp(-0.059 / cos_z) ELSE 0.0 END AS clear FROM sunny
)"""


FEATURES = WEATHER + ", " + sun("raw_weather", *map(str, PLACE)) + """, weather AS (
  SELECT datetime, shortwave_radiation AS global_tilted_irradiance, shortwave_radiation, cloud_cover, temperature_2m,
    CASE WHEN clear > 1 THEN greatest(0.0, least(1.2, shortwave_radiation / clear)) ELSE 0.0 END AS clearsky_index,
    greatest(cos_z, 0.0) AS effective_solar_pv, greatest(18 - temperature_2m, 0.0) AS heating_degree, greatest(temperature_2m - 24, 0.0) AS cooling_degree,
    CAST(cos_z > 0 AS INTEGER) AS is_daylight, greatest(degrees(asin(cos_z)), 0.0) AS solar_elevation,
    coalesce(cloud_cover - lag(cloud_cover) OVER (ORDER BY datetime), 0.0) AS cloud_cover_diff,
    1 - 0.004 * greatest(temperature_2m - 25, 0.0) AS pv_temp_factor
  FROM clear
)"""
LONG = HOURLY + """, actuals AS (
  SELECT device_id, ts_hour, 'grid_export' AS target, grid_export AS actual FROM hourly UNION ALL SELECT device_id, ts_hour, 'grid_import', grid_import FROM hourly
), ends AS (SELECT device_id, min(ts_hour) AS a, max(ts_hour) AS b FROM hourly GROUP BY 1
), origins AS (
  SELECT device_id, b - to_hours(CAST(24 * (i + 1) + 48 AS BIGINT)) AS origin FROM ends, range(21) r(i)
  WHERE b - to_hours(CAST(24 * (i + 1) + 48 AS BIGINT)) >= a + INTERVAL 336 HOUR
)"""
STEPS = LONG + """, steps AS (SELECT device_id, origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS ts_hour FROM origins, range(1, 49) r(h)
), naive AS (
  SELECT s.device_id, a.target, s.origin, s.ts_hour, s.horizon, greatest(coalesce(a.actual, 0.0), 0.0) AS prediction
  FROM steps s JOIN actuals a ON a.device_id = s.device_id AND a.ts_hour = s.ts_hour - INTERVAL 168 HOUR
), joined AS (
  SELECT n.*, a.actual, count(*) OVER (PARTITION BY n.device_id, n.target, n.origin) AS n
  FROM naive n JOIN actuals a ON a.device_id = n.device_id AND a.target = n.target AND a.ts_hour = n.ts_hour WHERE a.actual IS NOT NULL
), backtest AS (SELECT * EXCLUDE (n) FROM joined WHERE n >= 12)"""


def r(*columns: str) -> str:
    """Rounded output columns; "expr AS name" is taken apart."""
    parts = []
    for c in columns:
        expr, _, name = c.rpartition(" AS ")
        parts.append(f"round({expr or name}, 6) + 0.0 AS {name}")
    return ", ".join(parts)

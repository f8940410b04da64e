"""Registered queries of the meter operators, each with the SQL that must give the same rows, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock
from ..functions.solar import clearsky_ghi, solar_position
from ..operators import backends as BK
from ..operators import banded as N
from ..operators import cleaning as C
from ..operators import evaluation as E
from ..operators import features as X
from ..operators import flow as W
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import models as M
from ..operators import packed as PK
from ..operators import pooled as P
from ..operators import records as R
from ..operators import runlog as L
from ..operators import summaries as A
from ..operators import validation as V
from ..operators.forests import QuantileForest
from ..schema import Roles
from ..sources import readers as S
from ..sources import sinks as K
from ..streaming import streams as T
from . import base as B
from .base import CFG, r

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: B.out(f(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


H = ("M1_cons", "M1_prod", "grid_import", "grid_export", "net_exchange")
_HOURLY = f"device_id, ts_hour, {r(*H)}"


# ------------------------------------------------------------------ sources

@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s1_read_any(spark, sf):
    return S.read_any(spark, f"{sf}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def s4_read_table(spark, sf):
    B.table(spark, sf, "orders").createOrReplaceTempView("gridloom_orders")
    return S.read_table(spark, "gridloom_orders", {"o_orderstatus": "O", "o_orderpriority": ["1-URGENT", "2-HIGH"]}).select("o_orderkey", "o_custkey", "o_orderstatus")


@query(f"""WITH {B.METERS}, second AS (
  SELECT 'dev-' || CAST(user_id // {B.USERS} AS VARCHAR) AS device_id, time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS ts, max(value) AS consumption_kwh, min(value) AS production_kwh
  FROM events GROUP BY ALL)
SELECT device_id, ts, {r('consumption_kwh', 'production_kwh')} FROM meters
UNION ALL SELECT device_id, ts, {r('consumption_kwh', 'production_kwh')} FROM second s WHERE NOT EXISTS (SELECT 1 FROM meters m WHERE m.device_id = s.device_id AND m.ts = s.ts)""")
def s5_merge_sources(spark, sf):
    e = B.table(spark, sf, "events")
    slot = clock.floor_minutes(F.col("ts").cast("timestamp"), 15) + F.expr("INTERVAL 15 MINUTES")
    second = e.groupBy(S.meter_of(F.col("user_id"), B.USERS).alias("meter"), slot.alias("time")).agg(F.max("value").alias("kwh_in"), F.min("value").alias("kwh_out"))
    return S.merge_sources([(B.meters(spark, sf), None, None), (second, None, None)]).select("device_id", "ts", "consumption_kwh", "production_kwh")


@query(f"""WITH {B.WEATHER} SELECT datetime, {r('temperature_2m')} FROM raw_weather
UNION ALL SELECT datetime + INTERVAL 12 HOUR, {r('temperature_2m + 1 AS temperature_2m')} FROM raw_weather WHERE datetime + INTERVAL 12 HOUR > (SELECT b FROM wspan)""")
def s5w_merge_weather(spark, sf):
    w = B.raw_weather(spark, sf).select("datetime", "temperature_2m")
    later = w.select((F.col("datetime") + F.expr("INTERVAL 12 HOURS")).alias("at"), (F.col("temperature_2m") + 1).alias("t"))
    return S.merge_weather([(w, None), (later, {"at": "datetime", "t": "temperature_2m"})])


@query(f"""SELECT CAST(user_id AS VARCHAR) AS device_id, ts, {r('value AS consumption_kwh', 'CAST(event_id % 7 AS DOUBLE) AS production_kwh')} FROM events""")
def s6_normalize_meters(spark, sf):
    raw = B.table(spark, sf, "events").select(F.col("user_id").alias("POD"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"), F.col("value").cast("string").alias("prelievo"), (F.col("event_id") % 7).cast("string").alias("immissione"))
    return S.normalize_meters(raw)


@query("""WITH t AS (SELECT event_id, date_trunc('hour', ts) + INTERVAL 1 HOUR * (event_id % 8760) AS local FROM events),
u AS (SELECT *, (local AT TIME ZONE 'Europe/Rome') AT TIME ZONE 'UTC' AS a FROM t),
v AS (SELECT *, (a AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome' AS back,
  ((a + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome' AS later, ((a - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome' AS earlier FROM u)
SELECT event_id, local, CASE WHEN later = local OR earlier = local THEN NULL WHEN back <> local THEN date_trunc('hour', a) ELSE a END AS ts FROM v""")
def s7_localize_utc(spark, sf):
    e = B.table(spark, sf, "events")
    local = F.date_trunc("hour", F.col("ts").cast("timestamp")) + clock.hours(F.col("event_id") % 8760)
    return e.select("event_id", local.alias("local"), clock.localize_utc(local, "Europe/Rome").alias("ts"))


@query(f"""SELECT CAST(event_id AS BIGINT) AS event_id, ts AS datetime, {r('value AS temperature_2m', 'CAST(user_id AS DOUBLE) AS cloud_cover')} FROM events""")
def s8_hourly_payload(spark, sf):
    e = B.table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts"))
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = e.groupBy("day", "user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", at.alias("time"), F.col("value"), F.col("user_id").alias("u")))).alias("r"))
    payload = rows.select(F.struct(F.col("r.time").alias("time"), F.col("r.value").alias("temperature_2m"), F.col("r.u").alias("cloud_cover"), F.col("r.event_id").alias("event_id")).alias("hourly"))
    return S.hourly_payload_to_rows(payload).select(F.col("event_id").cast("long").alias("event_id"), "datetime", "temperature_2m", "cloud_cover")


@query(f"""WITH {B.WEATHER} SELECT datetime, {r("temperature_2m + CASE WHEN hour(datetime) >= 12 THEN 5 ELSE 0 END AS temperature_2m")} FROM raw_weather
WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def s9_stitch(spark, sf):
    w = B.raw_weather(spark, sf).select("datetime", "temperature_2m")
    return S.stitch_archive_forecast(w, w.where(F.hour("datetime") >= 12).withColumn("temperature_2m", F.col("temperature_2m") + 5), "2024-01-05", "2024-01-20")


# ------------------------------------------------------------------ validation and filters

_SUFF = f"""WITH {B.HOURLY}, s AS (
  SELECT device_id, count(*) FILTER (WHERE grid_import IS NOT NULL OR grid_export IS NOT NULL) AS energy_rows,
    (epoch(max(ts_hour) FILTER (WHERE grid_import IS NOT NULL OR grid_export IS NOT NULL)) - epoch(min(ts_hour) FILTER (WHERE grid_import IS NOT NULL OR grid_export IS NOT NULL))) / 86400.0 AS span
  FROM hourly GROUP BY 1), t AS (
  SELECT device_id, energy_rows, CASE WHEN energy_rows >= 2 THEN span ELSE 0 END AS span_days, CASE WHEN energy_rows >= 2 THEN energy_rows / greatest(span * 24, 1.0) ELSE 0 END AS coverage FROM s)
SELECT device_id, energy_rows, round(span_days, 3) + 0.0 AS span_days, round(coverage, 3) + 0.0 AS coverage, span_days >= 14 AND coverage >= 0.4 AS eligible FROM t"""


@query(_SUFF)
def v3_assess_sufficiency(spark, sf):
    return V.assess_sufficiency(B.hourly(spark, sf), CFG).select("device_id", "energy_rows", B.rounded("span_days", 3).alias("span_days"), B.rounded("coverage", 3).alias("coverage"), "eligible")


@query(f"""WITH {B.HOURLY} SELECT device_id, {r('avg(grid_export) AS mean_export', 'avg(grid_import) AS mean_import')},
  coalesce(avg(grid_export) >= 0.01, false) AS export_eligible, coalesce(avg(grid_import) >= 0.01, false) AS import_eligible FROM hourly GROUP BY 1""")
def v4_activity_gates(spark, sf):
    return V.activity_gates(B.hourly(spark, sf), CFG)


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def f1_start_date(spark, sf):
    return V.filter_start_date(B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "2024-01-15").select("event_id", "user_id")


@query(f"WITH {B.HOURLY} SELECT device_id, ts_hour FROM hourly WHERE NOT (grid_export_outlier OR grid_import_outlier)")
def f2_remove_outliers(spark, sf):
    return V.remove_outliers(B.hourly(spark, sf)).select("device_id", "ts_hour")


@query(f"WITH {B.ROLLED} SELECT device_id, ts_hour, {r('grid_import')} FROM targets WHERE ts_hour >= (SELECT max(ts_hour) FROM targets) - INTERVAL 1 DAY")
def f3_recent_window(spark, sf):
    return V.recent_window(B.rolled(spark, sf), 1).select("device_id", "ts_hour", "grid_import")


@query(f"""WITH {B.HOURLY}, g AS (SELECT device_id, avg(grid_export) AS x, avg(grid_import) AS i FROM hourly GROUP BY 1)
SELECT device_id, 'grid_export' AS target FROM g WHERE x >= 0.01 UNION ALL SELECT device_id, 'grid_import' FROM g WHERE i >= 0.01""")
def f4_target_gate(spark, sf):
    return V.target_gate(V.activity_gates(B.hourly(spark, sf), CFG))


@query(f"WITH {B.ROLLED} SELECT device_id, count(*) AS n FROM targets WHERE device_id NOT IN (SELECT device_id FROM targets GROUP BY 1 HAVING sum(grid_export) > sum(grid_import)) GROUP BY 1")
def f5_exclude_devices(spark, sf):
    df = B.rolled(spark, sf)
    gone = df.groupBy("device_id").agg((F.sum("grid_export") > F.sum("grid_import")).alias("x")).where("x")
    return V.exclude_devices(df, gone).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ cleaning

@query("""WITH m AS (SELECT user_id, date_trunc('hour', ts) AS ts, max({'value': value, 'id': event_id}) AS v FROM events GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS device_id, ts, round(v.value, 6) + 0.0 AS consumption_kwh, v.id AS event_id FROM m""")
def c1_dedupe_readings(spark, sf):
    e = B.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("device_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts"), F.col("value").alias("consumption_kwh"), "event_id")
    return C.dedupe_readings(e)


@query(f"WITH {B.ROLLED} SELECT device_id, ts_hour, {r('M1_cons', 'M1_prod')}, n_quarters, partial_hour FROM rolled")
def a1_hourly_rollup(spark, sf):
    return C.hourly_rollup(B.meters(spark, sf), CFG)


@query(f"WITH {B.ROLLED} SELECT {_HOURLY} FROM targets")
def c2_derive_targets(spark, sf):
    return B.rolled(spark, sf).select("device_id", "ts_hour", *H)


@query(f"WITH {B.GRID} SELECT {_HOURLY} FROM grid")
def c3_regular_grid(spark, sf):
    return C.regular_grid(B.rolled(spark, sf)).select("device_id", "ts_hour", *H)


@query(f"WITH {B.HOURLY} SELECT {_HOURLY}, gap_flag FROM hourly")
def c4_interpolate_gaps(spark, sf):
    return C.gap_flag(C.interpolate_gaps(C.regular_grid(B.rolled(spark, sf)))).select("device_id", "ts_hour", *H, "gap_flag")


_SITED = f"WITH {B.PLACED}, {B.sun('placed', 'latitude', 'longitude')}"


@query(f"WITH {B.FEATURES} SELECT datetime, {r('global_tilted_irradiance', 'coalesce(global_tilted_irradiance - lag(global_tilted_irradiance) OVER (ORDER BY datetime), 0.0) AS ghi_ramp')} FROM weather")
def c6_prepare_weather(spark, sf):
    return C.prepare_weather(B.weather(spark, sf), CFG).select("datetime", "global_tilted_irradiance", "ghi_ramp")


@query(f"WITH {B.HOURLY} SELECT device_id, ts_hour, hour_local, day_of_week, month, is_weekend, {r('hour_sin', 'hour_cos')} FROM hourly")
def c7_calendar(spark, sf):
    return C.calendar_features(C.regular_grid(B.rolled(spark, sf)), CFG.local_tz).select("device_id", "ts_hour", "hour_local", "day_of_week", "month", "is_weekend", "hour_sin", "hour_cos")


@query(f"WITH {B.HOURLY} SELECT device_id, ts_hour, grid_export_outlier, grid_import_outlier FROM hourly")
def w1_outlier_flags(spark, sf):
    return B.hourly(spark, sf).select("device_id", "ts_hour", "grid_export_outlier", "grid_import_outlier")


_P1 = ("global_tilted_irradiance", "temperature_2m", "theoretical_prod")


@query(f"""WITH {B.HOURLY}, {B.FEATURES.lstrip()} SELECT {_HOURLY}, coalesce(partial_hour, false) AS partial_hour, gap_flag, hour_local, grid_export_outlier, grid_import_outlier, w.is_daylight,
  {r('w.global_tilted_irradiance AS global_tilted_irradiance', 'w.temperature_2m AS temperature_2m', 'w.global_tilted_irradiance * w.effective_solar_pv AS theoretical_prod')}
  FROM hourly h LEFT JOIN weather w ON w.datetime = h.ts_hour""")
def p1_processed_hourly(spark, sf):
    return B.hourly(spark, sf, True).select("device_id", "ts_hour", *H, F.coalesce("partial_hour", F.lit(False)).alias("partial_hour"), "gap_flag", "hour_local", "grid_export_outlier", "grid_import_outlier", "is_daylight", *_P1)


# ------------------------------------------------------------------ weather

@query(f"{_SITED} SELECT site_id, datetime, {r('degrees(asin(cos_z)) AS solar_elevation', 'greatest(cos_z, 0.0) AS cos_zenith')} FROM clear")
def x1_solar_position(spark, sf):
    return solar_position(B.sited_weather(spark, sf), "datetime", "latitude", "longitude").select("site_id", "datetime", "solar_elevation", "cos_zenith")


_XF = ("global_tilted_irradiance", "shortwave_radiation", "cloud_cover", "temperature_2m", "clearsky_index", "effective_solar_pv", "heating_degree", "cooling_degree", "solar_elevation", "cloud_cover_diff", "pv_temp_factor")


@query(f"WITH {B.FEATURES} SELECT datetime, is_daylight, {r(*_XF)} FROM weather")
def x3_weather_features(spark, sf):
    return B.weather(spark, sf).select("datetime", "is_daylight", *_XF)


@query(f"""{_SITED} SELECT site_id, datetime, {r('CASE WHEN clear > 1 THEN greatest(0.0, least(1.2, shortwave_radiation / clear)) ELSE 0.0 END AS clearsky_index',
  'greatest(18 - temperature_2m, 0.0) AS heating_degree', 'coalesce(cloud_cover - lag(cloud_cover) OVER (PARTITION BY site_id ORDER BY datetime), 0.0) AS cloud_cover_diff')} FROM clear""")
def x4_weather_for_sites(spark, sf):
    raw = B.sited_weather(spark, sf).drop("latitude", "longitude")
    return C.weather_for_sites(raw, B.sites(spark, sf), CFG).select("site_id", "datetime", "clearsky_index", "heating_degree", "cloud_cover_diff")


# ------------------------------------------------------------------ joins

@query(f"""WITH {B.ROLLED}, {B.FEATURES.lstrip()} SELECT device_id, ts_hour, {r('temperature_2m', 'clearsky_index')} FROM targets LEFT JOIN weather ON datetime = ts_hour""")
def j1_merge_weather(spark, sf):
    return C.merge_weather_hourly(B.rolled(spark, sf), B.weather(spark, sf)).select("device_id", "ts_hour", "temperature_2m", "clearsky_index")


@query(f"""WITH {B.ROLLED} SELECT t.device_id, t.ts_hour, {r('a.grid_import AS lag_24h', 'b.grid_import AS lag_168h')} FROM targets t
  LEFT JOIN targets a ON a.device_id = t.device_id AND a.ts_hour = t.ts_hour - INTERVAL 24 HOUR LEFT JOIN targets b ON b.device_id = t.device_id AND b.ts_hour = t.ts_hour - INTERVAL 168 HOUR""")
def j2_lag_lookup(spark, sf):
    return J.lag_lookup(B.rolled(spark, sf), "device_id", "ts_hour", "grid_import", [24, 168], "lag").select("device_id", "ts_hour", "lag_24h", "lag_168h")


@query(f"""WITH {B.ROLLED}, w AS (SELECT DISTINCT make_timestamp(CAST(floor(epoch(ts) / 18000) AS BIGINT) * 18000000000) AS moment FROM events)
SELECT device_id, ts_hour, (SELECT min_by(moment, {{'d': abs(epoch(moment) - epoch(ts_hour)), 'e': -epoch(moment)}}) FROM w) AS nearest FROM targets""")
def j3_nearest(spark, sf):
    at = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 18000) * 18000)
    w = B.table(spark, sf, "events").select(at.alias("at"), at.alias("nearest")).distinct()
    return J.nearest_join(B.rolled(spark, sf), w, "ts_hour", "at").select("device_id", "ts_hour", "nearest")


@query(f"""WITH {B.ROLLED}, n AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM targets),
b AS (SELECT device_id, min(ts_hour) AS s, max(ts_hour) AS e FROM n WHERE k > (c * 70) // 100 AND k <= (c * 85) // 100 GROUP BY 1)
SELECT t.device_id, t.ts_hour FROM targets t JOIN b ON b.device_id = t.device_id AND t.ts_hour BETWEEN s AND e""")
def j5_band_join(spark, sf):
    df = B.rolled(spark, sf)
    _, bounds, _ = X.pool_state(df, "grid_import", 10, 10)
    return J.band_join(df, bounds).select("device_id", "ts_hour")


@query(f"WITH {B.STEPS} SELECT s.device_id, s.origin, s.ts_hour, s.horizon, {r('h.grid_import AS grid_import')} FROM steps s JOIN hourly h ON h.device_id = s.device_id AND h.ts_hour = s.ts_hour")
def j6_origin_join(spark, sf):
    df = B.hourly(spark, sf)
    return J.origin_join(df.select("device_id", "ts_hour", "grid_import"), E.backtest_origins(df, CFG)).select("device_id", "origin", "ts_hour", "horizon", "grid_import")


@query(f"""WITH {B.LONG} SELECT o.device_id, o.origin, h.ts_hour, {r('h.grid_import AS grid_import')} FROM origins o
  JOIN hourly h ON h.device_id = o.device_id AND h.ts_hour <= o.origin AND h.ts_hour > o.origin - INTERVAL 336 HOUR""")
def j6_origin_history(spark, sf):
    """Each origin's last 14 days, joined by day."""
    df = B.stored(B.hourly(spark, sf).select("device_id", "ts_hour", "grid_import"))
    return J.origin_join(df, E.backtest_origins(df, CFG), "history", back_hours=336).select("device_id", "origin", "ts_hour", "grid_import")


# ------------------------------------------------------------------ summaries

@query(f"""WITH {B.HOURLY} SELECT device_id, round(avg(grid_import), 4) + 0.0 AS mean_import, round(avg(net_exchange), 4) + 0.0 AS mean_net,
  CASE WHEN avg(net_exchange) > 0.1 THEN 'Net Exporter' WHEN avg(net_exchange) < -0.1 THEN 'Net Importer' ELSE 'Balanced' END AS segment FROM hourly WHERE NOT gap_flag GROUP BY 1""")
def a2_segment_devices(spark, sf):
    return A.segment_devices(B.hourly(spark, sf)).select("device_id", "mean_import", "mean_net", "segment")


@query(f"WITH {B.HOURLY} SELECT hour_local, {r('avg(grid_import) AS grid_import', 'avg(grid_export) AS grid_export', 'avg(net_exchange) AS net_exchange')} FROM hourly WHERE NOT gap_flag GROUP BY 1")
def a3_hourly_profiles(spark, sf):
    return A.hourly_profiles(B.hourly(spark, sf))


@query(f"""WITH {B.HOURLY}, {B.FEATURES.lstrip()}, j AS (SELECT * FROM hourly JOIN weather ON datetime = ts_hour WHERE NOT gap_flag AND weather.is_daylight = 1)
""" + " UNION ALL ".join(f"SELECT '{t}' AS target, '{w}' AS weather, round(corr({t}, {w}), 3) + 0.0 AS correlation FROM j" for t in ("grid_import", "grid_export", "net_exchange") for w in ("temperature_2m", "effective_solar_pv")))
def a4_weather_correlations(spark, sf):
    return A.weather_correlations(B.hourly(spark, sf, True), columns=["temperature_2m", "effective_solar_pv"])


_ERR = "sqrt(avg((prediction - actual) ** 2)) AS rmse", "avg(abs(prediction - actual)) AS mae", "avg(prediction - actual) AS mbe"


def _backtest(spark, sf):
    """The hourly table is written once: origins, forecasts and actuals of both targets read it."""
    return E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, E.naive_backend(CFG))


@query(f"""WITH {B.STEPS} SELECT device_id, target, {r(*_ERR, '100 * avg(CASE WHEN abs(actual) >= 0.1 THEN abs((prediction - actual) / actual) END) AS mape')}, count(*) AS n_samples FROM backtest GROUP BY 1, 2""")
def a5_metrics(spark, sf):
    return A.metrics(_backtest(spark, sf).drop("lower", "upper"), ["device_id", "target"])


@query(f"WITH {B.STEPS} SELECT coalesce(device_id, '*') AS device_id, target, coalesce(horizon, 0) AS horizon, {r(*_ERR[:2])}, count(*) AS n_samples FROM backtest GROUP BY GROUPING SETS ((device_id, target), (target), (target, horizon))")
def a6_summaries(spark, sf):
    return A.backtest_rollup(_backtest(spark, sf)).na.fill({"device_id": "*", "horizon": 0})


@query(f"""WITH {B.STEPS}, b AS (SELECT device_id, target, horizon, avg(prediction - actual) AS bias FROM backtest GROUP BY ALL)
SELECT k.device_id, k.target, k.origin, k.horizon, {r('greatest(prediction - bias, 0.0) AS prediction')} FROM backtest k JOIN b USING (device_id, target, horizon)""")
def a7_bias(spark, sf):
    bt = _backtest(spark, sf)
    return A.apply_bias(bt, A.per_horizon_bias(bt)).select("device_id", "target", "origin", "horizon", "prediction")


@query(f"""WITH {B.STEPS}, c AS (SELECT *, count(*) OVER (PARTITION BY device_id, target, origin) AS n FROM backtest),
m AS (SELECT device_id, target, count(DISTINCT horizon) AS n FROM backtest GROUP BY 1, 2),
k AS (SELECT c.*, dense_rank() OVER (PARTITION BY device_id, target ORDER BY origin) AS rk FROM c JOIN m USING (device_id, target, n)),
f AS (SELECT *, max(rk) OVER (PARTITION BY device_id, target) // 2 AS half FROM k),
b AS (SELECT device_id, target, horizon, avg(prediction - actual) AS bias FROM f WHERE rk <= half GROUP BY ALL),
e AS (SELECT device_id, target, avg(abs(greatest(prediction - bias, 0.0) - actual)) AS v FROM f JOIN b USING (device_id, target, horizon) WHERE rk > half AND half > 0 GROUP BY 1, 2)
SELECT DISTINCT k2.device_id, k2.target, {r('v AS mae_bias_corrected')} FROM backtest k2 LEFT JOIN e USING (device_id, target)""")
def a8_bias_corrected(spark, sf):
    return A.bias_corrected_mae(_backtest(spark, sf))


@query(f"""WITH {B.STEPS}, q AS (SELECT device_id, (greatest(0.25 * (actual - 0.5 * prediction), -0.75 * (actual - 0.5 * prediction)) + greatest(0.5 * (actual - prediction), -0.5 * (actual - prediction))
  + greatest(0.75 * (actual - 1.5 * prediction), -0.25 * (actual - 1.5 * prediction))) / 3 AS l FROM backtest) SELECT device_id, {r('avg(l) AS pinball_loss')} FROM q GROUP BY 1""")
def a10_pinball(spark, sf):
    bt = _backtest(spark, sf).withColumn("q", F.array(F.col("prediction") * 0.5, F.col("prediction"), F.col("prediction") * 1.5))
    return A.pinball_loss(bt, "actual", "q", [0.25, 0.5, 0.75], ["device_id"])


# ------------------------------------------------------------------ features

@query(f"""WITH {B.HOURLY} SELECT device_id, ts_hour, {r('CASE WHEN count(grid_import) OVER w >= 12 THEN avg(grid_import) OVER w END AS grid_import_roll_24h_mean', 'CASE WHEN count(grid_import) OVER w >= 12 THEN stddev_samp(grid_import) OVER w END AS grid_import_roll_24h_std')}
FROM hourly WINDOW w AS (PARTITION BY device_id ORDER BY ts_hour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)""")
def w2_roll_24h(spark, sf):
    return X.roll_24h(B.hourly(spark, sf).select("device_id", "ts_hour", "grid_import"), "grid_import").drop("grid_import")


_DAYS = (1, 2, 3, 4, 5, 6, 7, 14)
_W3 = f"""WITH {B.HOURLY}, days AS (SELECT h.device_id, h.ts_hour, h.grid_import AS y, {', '.join(f'd{k}.grid_import AS d{k}' for k in _DAYS)} FROM hourly h
  {' '.join(f'LEFT JOIN hourly d{k} ON d{k}.device_id = h.device_id AND d{k}.ts_hour = h.ts_hour - INTERVAL {24 * k} HOUR' for k in _DAYS)}),
rolls AS (SELECT device_id, ts_hour AS moment, CASE WHEN count(grid_import) OVER w >= 12 THEN avg(grid_import) OVER w END AS m FROM hourly WINDOW w AS (PARTITION BY device_id ORDER BY ts_hour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)),
x AS (SELECT d.*, CAST(h AS INTEGER) AS horizon, CASE WHEN h > 24 THEN d2 ELSE d1 END AS f FROM days d, (VALUES (6), (36)) v(h))
SELECT x.device_id, ts_hour, horizon, {r('y AS grid_import', 'f AS grid_import_same_hour_1d', 'd14 AS grid_import_same_hour_14d',
  '(SELECT avg(v) FROM (SELECT unnest([CASE WHEN horizon <= 24 THEN d1 END, d2, d3, d4, d5, d6, d7]) AS v)) AS grid_import_mean_same_hour_7d', 'd7 - d14 AS grid_import_diff_7d', 'm AS grid_import_roll_24h_mean')}
FROM x LEFT JOIN rolls ON rolls.device_id = x.device_id AND moment = ts_hour - to_hours(CAST(horizon AS BIGINT))"""


@query(_W3)
def w3_train_lags(spark, sf):
    names = ("same_hour_1d", "same_hour_14d", "mean_same_hour_7d", "diff_7d", "roll_24h_mean")
    return X.train_lags(B.hourly(spark, sf), "grid_import", [6, 36]).select("device_id", "ts_hour", "horizon", "grid_import", *(f"grid_import_{n}" for n in names))


@query(_W3.replace("FROM x LEFT JOIN", "FROM x LEFT JOIN") + " WHERE y IS NOT NULL AND ts_hour <= TIMESTAMP '2024-01-20'")
def w4_training_matrix(spark, sf):
    names = ("same_hour_1d", "same_hour_14d", "mean_same_hour_7d", "diff_7d", "roll_24h_mean")
    return X.training_matrix(B.hourly(spark, sf), "grid_import", [6, 36], CFG, train_end="2024-01-20").select("device_id", "ts_hour", "horizon", "grid_import", *(f"grid_import_{n}" for n in names))


@query(f"""WITH {B.STEPS} SELECT s.device_id, s.origin, s.ts_hour, s.horizon, {r('CASE WHEN s.horizon > 24 THEN b.grid_import ELSE a.grid_import END AS grid_import_same_hour_1d', 'c.grid_import AS grid_import_same_hour_7d')} FROM steps s
  LEFT JOIN hourly a ON a.device_id = s.device_id AND a.ts_hour = s.ts_hour - INTERVAL 24 HOUR LEFT JOIN hourly b ON b.device_id = s.device_id AND b.ts_hour = s.ts_hour - INTERVAL 48 HOUR
  LEFT JOIN hourly c ON c.device_id = s.device_id AND c.ts_hour = s.ts_hour - INTERVAL 168 HOUR""")
def w5_forecast_matrix(spark, sf):
    df = B.hourly(spark, sf)
    return X.forecast_matrix(df, E.backtest_origins(df, CFG), "grid_import", CFG).select("device_id", "origin", "ts_hour", "horizon", "grid_import_same_hour_1d", "grid_import_same_hour_7d")


@query(f"""WITH {B.STEPS}, {B.FEATURES.lstrip()}, nearest AS (
  SELECT t.ts_hour, min_by(w.datetime, {{'d': abs(epoch(w.datetime) - epoch(t.ts_hour)), 'e': -epoch(w.datetime)}}) AS datetime
  FROM (SELECT DISTINCT ts_hour FROM steps) t, weather w WHERE hour(w.datetime) % 2 = 0 GROUP BY 1)
SELECT s.device_id, s.origin, s.ts_hour, s.horizon, {r('c.grid_import - d.grid_import AS grid_import_diff_7d', 'w.temperature_2m AS temperature_2m', 'w.heating_degree AS heating_degree')} FROM steps s
  LEFT JOIN hourly c ON c.device_id = s.device_id AND c.ts_hour = s.ts_hour - INTERVAL 168 HOUR LEFT JOIN hourly d ON d.device_id = s.device_id AND d.ts_hour = s.ts_hour - INTERVAL 336 HOUR
  JOIN nearest n ON n.ts_hour = s.ts_hour JOIN weather w ON w.datetime = n.datetime""")
def w5_forecast_weather(spark, sf):
    """Weather of every second hour: the nearest one is taken, the later of two."""
    df, w = B.stored(B.hourly(spark, sf)), B.weather(spark, sf)
    rows = X.forecast_matrix(df, E.backtest_origins(df, CFG), "grid_import", CFG, w.where(F.hour("datetime") % 2 == 0))
    return rows.select("device_id", "origin", "ts_hour", "horizon", "grid_import_diff_7d", "temperature_2m", "heating_degree")


@query(f"""WITH {B.STEPS}, {B.FEATURES.lstrip()}, k AS (SELECT o.device_id, o.origin, h.grid_import AS y, row_number() OVER (PARTITION BY o.device_id, o.origin ORDER BY h.ts_hour DESC) AS i FROM origins o JOIN hourly h ON h.device_id = o.device_id AND h.ts_hour <= o.origin),
past AS (SELECT device_id, origin, coalesce(sum(y), 0.0) AS ctx_sum FROM k WHERE i <= 48 GROUP BY ALL HAVING count(*) = 48),
ahead AS (SELECT s.device_id, s.origin, sum(w.temperature_2m) AS temperature FROM steps s JOIN weather w ON w.datetime = s.ts_hour GROUP BY ALL)
SELECT device_id, origin, {r('ctx_sum', 'temperature')} FROM past JOIN ahead USING (device_id, origin)""")
def w15_future_weather(spark, sf):
    df, w = B.stored(B.hourly(spark, sf, True)), B.weather(spark, sf)
    out = X.context_and_future(df.drop("temperature_2m").withColumn("temperature_2m", F.lit(0.0)), E.backtest_origins(df, CFG), "grid_import", 48, CFG, w, ["temperature_2m"])
    add = lambda c, f: F.aggregate(c, F.lit(0.0), lambda a, x: a + F.coalesce(f(x), F.lit(0.0)))
    return out.select("device_id", "origin", add("ctx_target", lambda x: x).alias("ctx_sum"), add("future_cov", lambda x: F.element_at(x, 1)).alias("temperature"))


@query(f"""WITH {B.ROLLED}, n AS (SELECT device_id, ts_hour, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM targets)
SELECT device_id, ts_hour, CASE WHEN k <= (c * 70) // 100 THEN 'train' WHEN k <= (c * 85) // 100 THEN 'valid' ELSE 'test' END AS split FROM n""")
def w7_split(spark, sf):
    return X.split_70_15_15(B.rolled(spark, sf)).select("device_id", "ts_hour", "split")


_POOL = f"""WITH {B.ROLLED}, n AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM targets),
s AS (SELECT device_id, avg(ln(1 + grid_import)) FILTER (WHERE k <= (c * 70) // 100) AS log_mean, stddev_pop(ln(1 + grid_import)) FILTER (WHERE k <= (c * 70) // 100) AS log_std,
  min(ts_hour) FILTER (WHERE k > (c * 70) // 100 AND k <= (c * 85) // 100) AS valid_start, max(ts_hour) FILTER (WHERE k > (c * 70) // 100 AND k <= (c * 85) // 100) AS valid_end FROM n GROUP BY 1)"""


@query(f"{_POOL} SELECT device_id, {r('log_mean', 'log_std')}, valid_start, valid_end FROM s")
def w8_pool_state(spark, sf):
    scalers, bounds, _ = X.pool_state(B.rolled(spark, sf), "grid_import", 24, 24)
    return scalers.join(bounds, "device_id")


@query(f"{_POOL} SELECT t.device_id, t.ts_hour, {r('(ln(1 + grid_import) - log_mean) / log_std AS grid_import')} FROM targets t JOIN s USING (device_id)")
def w9_log_standardize(spark, sf):
    df = B.rolled(spark, sf)
    return X.log_standardize(df, X.pool_state(df, "grid_import", 24, 24)[0], "grid_import").select("device_id", "ts_hour", "grid_import")


@query(f"""WITH {B.ROLLED}, n AS (SELECT device_id, ts_hour, grid_import AS y, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM targets)
SELECT a.device_id, a.ts_hour AS origin, {r('sum(b.y) FILTER (WHERE b.k <= a.k) AS ctx_sum', 'sum(b.y) FILTER (WHERE b.k > a.k) AS target_sum')}
FROM n a JOIN n b ON b.device_id = a.device_id AND b.k BETWEEN a.k - 23 AND a.k + 12 WHERE a.k >= 24 AND (a.k - 24) % 6 = 0 AND a.k + 12 <= a.c GROUP BY ALL""")
def w10_sequence_windows(spark, sf):
    w = X.sequence_windows(B.rolled(spark, sf), "grid_import", 24, 12, 6)
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return w.select("device_id", "origin", add("ctx_target").alias("ctx_sum"), add("target").alias("target_sum"))


@query(f"""{_POOL}, z AS (SELECT n.device_id, ts_hour, k, c, (ln(1 + grid_import) - log_mean) / log_std AS y FROM n JOIN s USING (device_id)),
a AS (SELECT *, sum(y) OVER p AS ctx_sum, sum(y) OVER f AS target_sum FROM z
  WINDOW p AS (PARTITION BY device_id ORDER BY k ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), f AS (PARTITION BY device_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING))
SELECT device_id, ts_hour AS origin, {r('ctx_sum', 'target_sum')} FROM a WHERE k >= 24 AND k + 12 <= (c * 70) // 100 AND (k - 24) % 6 = 0""")
def w11_supervised_windows(spark, sf):
    df = B.rolled(spark, sf)
    w = X.supervised_windows(df, "grid_import", X.pool_state(df, "grid_import", 24, 24)[0], 24, 12, 6)
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return w.select("device_id", "origin", add("ctx_target").alias("ctx_sum"), add("target").alias("target_sum"))


@query(f"""WITH {B.ROLLED}, l AS (SELECT device_id, (count(*) * 70) // 100 AS a, (count(*) * 85) // 100 AS b FROM targets GROUP BY 1)
SELECT device_id, CAST(greatest(0, (a - 24 - 12) // 6 + 1) AS BIGINT) AS train_windows, CAST(greatest(0, (b - 24 - 12) // 12 + 1) AS BIGINT) AS valid_windows,
  CAST(greatest(0, least(512, min(a) OVER () - 12) // 32 * 32) AS BIGINT) AS effective_context FROM l""")
def w12_window_counts(spark, sf):
    n = F.count(F.lit(1))
    lengths = B.rolled(spark, sf).groupBy("device_id").agg(F.floor(n * 70 / 100).alias("n_train"), F.floor(n * 85 / 100).alias("n_valid"))
    fits = X.window_counts(lengths, 512, 12, 6).select("device_id", "effective_context")
    return X.window_counts(lengths, 24, 12, 6).drop("effective_context").join(fits, "device_id")


@query(f"""WITH {B.GRID} SELECT device_id, ts_hour, {r('coalesce(last_value(grid_import IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(grid_import IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0) AS grid_import')} FROM grid""")
def w13_gap_fill(spark, sf):
    return X.gap_fill(C.regular_grid(B.rolled(spark, sf)).select("device_id", "ts_hour", "grid_import"), "grid_import")


@query(f"""{_POOL}, z AS (SELECT n.device_id, k, c, (ln(1 + grid_import) - log_mean) / log_std AS y FROM n JOIN s USING (device_id))
SELECT device_id, CAST(count(*) FILTER (WHERE k <= (c * 70) // 100) AS INTEGER) AS "offset", CAST(count(*) AS INTEGER) AS n_valid, {r('sum(y) AS total')} FROM z WHERE k <= (c * 85) // 100 GROUP BY 1""")
def w14_finetune_series(spark, sf):
    df = B.rolled(spark, sf)
    s = X.finetune_series(df, "grid_import", X.pool_state(df, "grid_import", 24, 24)[0], 24)
    return s.select("device_id", "offset", F.size("valid").alias("n_valid"), F.aggregate("valid", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query(f"""WITH {B.LONG}, k AS (SELECT o.device_id, o.origin, h.grid_import AS y, row_number() OVER (PARTITION BY o.device_id, o.origin ORDER BY h.ts_hour DESC) AS i FROM origins o JOIN hourly h ON h.device_id = o.device_id AND h.ts_hour <= o.origin)
SELECT device_id, origin, {r('coalesce(sum(y), 0.0) AS ctx_sum')}, 48 AS n_future FROM k WHERE i <= 48 GROUP BY ALL HAVING count(*) = 48""")
def w15_context_and_future(spark, sf):
    df = B.hourly(spark, sf)
    w = X.context_and_future(df, E.backtest_origins(df, CFG), "grid_import", 48, CFG, covariates=["hour_sin", "hour_cos"])
    return w.select("device_id", "origin", F.aggregate("ctx_target", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))).alias("ctx_sum"), F.size("future_cov").alias("n_future"))


# ------------------------------------------------------------------ models and intervals

@query(f"WITH {B.STEPS} SELECT device_id, target, origin, ts_hour, horizon, {r('prediction')} FROM naive WHERE target = 'grid_import'")
def m1_naive(spark, sf):
    df = B.hourly(spark, sf)
    return M.naive_forecast(df, E.backtest_origins(df, CFG), "grid_import", CFG)


def _matrix(spark, sf, horizons=None, pack=False):
    """The training rows of all horizons, as the backtests take them; m2a's SQL has one horizon."""
    return M.with_band(X.training_matrix(B.hourly(spark, sf), "grid_import", list(horizons or range(1, CFG.horizon + 1)), CFG, pack=pack), CFG)


def _rows(spark, sf):
    """The matrix as rows with is_validation, for models that take no packed ones; their parts have a million rows whatever the size of the tables."""
    hours = B.stored(X.time_split(_matrix(spark, sf, pack=True), CFG.validation_split))
    n = hours.agg(F.sum(F.size("_h"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 1_000_000))
    return PK.unpacked(hours.repartition(parts, "device_id", F.to_date("ts_hour")), "grid_import")


def _packed_rows(spark, sf):
    """The packed matrix with is_validation."""
    return B.stored(X.time_split(_matrix(spark, sf, pack=True), CFG.validation_split))


def _names():
    return V.resolve_features("grid_import", CFG, True, list(CFG.calendar))


def _inputs(matrix):
    return V.resolve_features("grid_import", CFG, True, matrix.columns)


@query(f"""WITH {B.HOURLY} SELECT a.device_id, {r('regr_slope(a.grid_import, b.grid_import) AS slope', 'regr_intercept(a.grid_import, b.grid_import) AS intercept')}, CAST(regr_count(a.grid_import, b.grid_import) AS BIGINT) AS n
FROM hourly a LEFT JOIN hourly b ON b.device_id = a.device_id AND b.ts_hour = a.ts_hour - INTERVAL 168 HOUR WHERE a.grid_import IS NOT NULL GROUP BY 1""")
def m2a_seasonal_linear(spark, sf):
    return M.seasonal_linear(_matrix(spark, sf, (6,)), "grid_import")


@query()
def m2_grouped_linear(spark, sf):
    matrix = B.stored(_matrix(spark, sf, pack=True))
    linear = M.GroupedLinear("grid_import", _inputs(matrix), ["device_id", "band"])
    scored = linear.told(matrix, {"prediction": B.stored(linear.fit(matrix))}, ["device_id", "band", "grid_import"])
    return A.metrics(scored.withColumn("actual", F.col("grid_import")), ["device_id", "band"])


#: Intercept and slopes on the sine and cosine of the hour, by the normal equations, from sums over groups.
_LINE = """var_pop(hour_sin) AS va, var_pop(hour_cos) AS vb, covar_pop(hour_sin, hour_cos) AS ab, covar_pop(hour_sin, y) AS ay, covar_pop(hour_cos, y) AS by_,
    avg(hour_sin) AS ma, avg(hour_cos) AS mb, avg(y) AS my"""
_SLOPES = "(ay * vb - by_ * ab) / (va * vb - ab * ab) AS s, (by_ * va - ay * ab) / (va * vb - ab * ab) AS c, my - (ay * vb - by_ * ab) / (va * vb - ab * ab) * ma - (by_ * va - ay * ab) / (va * vb - ab * ab) * mb AS i"
_CLOCK = ["hour_sin", "hour_cos"]


@query(f"""WITH {B.HOURLY}, f AS (SELECT device_id, {_LINE} FROM (SELECT *, grid_import AS y FROM hourly WHERE grid_import IS NOT NULL) GROUP BY 1), l AS (SELECT device_id, {_SLOPES} FROM f)
SELECT device_id, band, round(i, 5) + 0.0 AS intercept, round(s, 5) + 0.0 AS on_sine, round(c, 5) + 0.0 AS on_cosine FROM l, (VALUES ('short'), ('medium'), ('long')) v(band)""")
def m2_two_inputs(spark, sf):
    """The coefficients on two inputs, whose normal equations have a closed form."""
    linear = M.GroupedLinear("grid_import", _CLOCK, ["device_id", "band"], ridge=0.0)
    at = lambda i, name: B.rounded(F.get("coefficients", F.lit(i)), 5).alias(name)
    return linear.fit(_matrix(spark, sf, pack=True)).select("device_id", "band", at(0, "intercept"), at(1, "on_sine"), at(2, "on_cosine"))


@query()
def m3_gbt_pooled(spark, sf):
    matrix = _rows(spark, sf)
    gbt = M.GbtPooled("grid_import", _inputs(matrix), validation="is_validation")
    return A.metrics(gbt.predict(gbt.fit(matrix), matrix).withColumn("actual", F.col("grid_import")), ["device_id"])


@query()
def m4_tweedie(spark, sf):
    matrix = _rows(spark, sf)
    glm = M.TweedieImport("grid_import", _inputs(matrix))
    return A.metrics(glm.predict(glm.fit(matrix), matrix).withColumn("actual", F.col("grid_import")), ["device_id"])


@query()
def m4_grouped_tweedie(spark, sf):
    """A model of zero-inflated imports for each device and band, by reweighted least squares."""
    matrix = B.stored(_matrix(spark, sf, pack=True))
    tweedie = M.GroupedTweedie("grid_import", _inputs(matrix), ["device_id", "band"], ridge=CFG.ridge, tolerance=1e-6, store=B.stored)
    return A.metrics(tweedie.predict(tweedie.fit(matrix), matrix).withColumn("actual", F.col("grid_import")), ["device_id", "band"])


@query()
def m5_quantile_forest(spark, sf):
    """Twenty trees: the share of each device's hours inside the quarter quantiles, of rows the forest wasn't fitted on."""
    matrix = _packed_rows(spark, sf)
    forest = QuantileForest("grid_import", _names(), store=B.stored)
    told = forest.predict(forest.fit(matrix.where("not is_validation")), matrix.where("is_validation"), ["device_id", "grid_import"])
    inside = F.col("grid_import").between(F.col("q_low"), F.col("q_high")).cast("double")
    return told.groupBy("device_id").agg(F.avg(inside).alias("inside"), F.count(F.lit(1)).alias("n"))


@query()
def m5_quantile_leaf(spark, sf):
    matrix = _rows(spark, sf)
    q = M.quantile_leaf(matrix, matrix, "grid_import", _inputs(matrix))
    inside = F.col("grid_import").between(F.col("q_low"), F.col("q_high")).cast("double")
    return q.groupBy("device_id").agg(F.avg(inside).alias("inside"), F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(h AS INTEGER) AS horizon, CASE WHEN h <= 8 THEN 'short' WHEN h <= 24 THEN 'medium' ELSE 'long' END AS band, (SELECT count(*) FROM events WHERE event_id % 48 + 1 = h) AS n FROM range(1, 49) r(h)")
def m6_bands(spark, sf):
    e = B.table(spark, sf, "events").select((F.col("event_id") % 48 + 1).cast("int").alias("horizon"))
    return M.with_band(e, CFG).groupBy("horizon", "band").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {B.ROLLED}, k AS (SELECT device_id, ts_hour, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS i, count(*) OVER (PARTITION BY device_id) AS c FROM targets)
SELECT device_id, ts_hour, i > floor(c * CAST(0.85 AS DOUBLE)) AS is_validation FROM k""")
def m7_time_split(spark, sf):
    return X.time_split(B.rolled(spark, sf), CFG.validation_split).select("device_id", "ts_hour", "is_validation")


@query(f"""WITH {B.HOURLY} SELECT device_id, band, 0.0 AS largest_gap, count(*) * h AS n FROM hourly, (VALUES ('short', 8), ('medium', 16), ('long', 24)) v(band, h) WHERE grid_import IS NOT NULL GROUP BY device_id, band, h""")
def m9_warm_start(spark, sf):
    """The model after an update with the last week equals a refit: the largest difference of their predictions is 0."""
    matrix = B.stored(_matrix(spark, sf, pack=True))
    linear = M.GroupedLinear("grid_import", _inputs(matrix), ["device_id", "band"])
    old, new = matrix.where("ts_hour < TIMESTAMP '2024-01-23'"), matrix.where("ts_hour >= TIMESTAMP '2024-01-23'")
    models = {"updated": linear.solve(linear.update(linear.statistics(old), new)), "refit": linear.fit(matrix)}
    both = linear.told(matrix, {name: B.stored(model) for name, model in models.items()}, ["device_id", "band"])
    return both.groupBy("device_id", "band").agg(F.round(F.max(F.abs(F.col("updated") - F.col("refit"))), 3).alias("largest_gap"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {B.STEPS}, s AS (SELECT device_id, target, abs(actual - prediction) AS v FROM backtest), c AS (SELECT *, count(*) OVER (PARTITION BY device_id, target) AS n, row_number() OVER (PARTITION BY device_id, target ORDER BY v) - 1 AS k FROM s),
p AS (SELECT *, least(ceil((n + 1) * CAST(0.5 AS DOUBLE) - 1e-12) / n, 1.0) * (n - 1) AS pos FROM c)
SELECT device_id, target, {r('CASE WHEN max(n) < 30 THEN 0.0 ELSE sum(CASE WHEN k = floor(pos) THEN (1 - (pos - floor(pos))) * v WHEN k = floor(pos) + 1 THEN (pos - floor(pos)) * v END) END AS q')}, max(n) AS n FROM p GROUP BY 1, 2""")
def i1_conformal_quantile(spark, sf):
    bt = _backtest(spark, sf).withColumn("s", F.abs(F.col("actual") - F.col("prediction")))
    return I.conformal_quantile(bt, "s", ["device_id", "target"], 0.5)


def _with_quantiles(spark, sf):
    return _backtest(spark, sf).withColumns({"q_low": F.col("prediction") * 0.75, "q_high": F.col("prediction") * 1.25})


_CQR = f"""WITH {B.STEPS}, s AS (SELECT *, greatest(prediction * 0.75 - actual, actual - prediction * 1.25) AS v FROM backtest),
t AS (SELECT device_id, target, quantile_cont(prediction, 0.5) AS threshold FROM s GROUP BY 1, 2),
c AS (SELECT s.*, threshold, prediction > threshold AS active FROM s JOIN t USING (device_id, target)),
k AS (SELECT *, count(*) OVER (PARTITION BY device_id, target, active) AS m, row_number() OVER (PARTITION BY device_id, target, active ORDER BY v) - 1 AS i FROM c),
p AS (SELECT *, least(ceil((m + 1) * CAST(0.5 AS DOUBLE) - 1e-12) / m, 1.0) * (m - 1) AS pos FROM k),
q AS (SELECT device_id, target, active, CASE WHEN max(m) <= 30 THEN 0.0 ELSE sum(CASE WHEN i = floor(pos) THEN (1 - (pos - floor(pos))) * v WHEN i = floor(pos) + 1 THEN (pos - floor(pos)) * v END) END AS q FROM p GROUP BY ALL),
cqr AS (SELECT device_id, target, threshold, coalesce(max(q) FILTER (WHERE active), 0.0) AS q_active, coalesce(max(q) FILTER (WHERE NOT active), 0.0) AS q_idle FROM t JOIN q USING (device_id, target) GROUP BY ALL)"""


@query(f"{_CQR} SELECT device_id, target, {r('threshold', 'q_active', 'q_idle')} FROM cqr")
def i2_cqr_two_regime(spark, sf):
    return I.cqr_two_regime(B.stored(_with_quantiles(spark, sf)), ["device_id", "target"], CFG)


@query(f"""{_CQR}, w AS (SELECT b.*, CASE WHEN prediction > threshold THEN q_active ELSE q_idle END AS add FROM backtest b JOIN cqr USING (device_id, target))
SELECT device_id, target, origin, horizon, {r('prediction', 'least(prediction, greatest(0.0, prediction * 0.75 - add)) AS prediction_lower', 'greatest(prediction, greatest(0.0, prediction * 1.25 + add)) AS prediction_upper')} FROM w""")
def i3_apply_cqr(spark, sf):
    bt = B.stored(_with_quantiles(spark, sf))
    q = I.cqr_two_regime(bt, ["device_id", "target"], CFG)
    return I.apply_cqr(bt, q, ["device_id", "target"]).select("device_id", "target", "origin", "horizon", "prediction", "prediction_lower", "prediction_upper")


def _offsets(spark, sf):
    df = B.stored(B.hourly(spark, sf))
    _, bounds, _ = X.pool_state(df, "grid_import", 48, 48)
    starts = bounds.select("device_id", F.explode(F.sequence(F.col("valid_start") - F.expr("INTERVAL 1 HOUR"), F.col("valid_end"), F.expr("INTERVAL 48 HOURS"))).alias("origin"))
    fc = M.naive_forecast(df, starts, "grid_import", CFG).where("prediction is not null")
    return df, fc, I.pooled_offsets(fc, df.select("device_id", "ts_hour", F.col("grid_import").alias("actual")), bounds, CFG)


_OFFSETS = f"""WITH {B.HOURLY}, o AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM hourly),
bounds2 AS (SELECT device_id, min(ts_hour) AS s, max(ts_hour) AS e FROM o WHERE k > (c * 70) // 100 AND k <= (c * 85) // 100 GROUP BY 1),
starts AS (SELECT device_id, s, e, unnest(generate_series(s - INTERVAL 1 HOUR, e, INTERVAL 48 HOUR)) AS origin FROM bounds2),
fc AS (SELECT t.device_id, s, e, origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS ts_hour, greatest(coalesce(l.grid_import, 0.0), 0.0) AS prediction
  FROM starts t CROSS JOIN range(1, 49) r(h) JOIN hourly l ON l.device_id = t.device_id AND l.ts_hour = origin + to_hours(CAST(h AS BIGINT)) - INTERVAL 168 HOUR),
res AS (SELECT fc.device_id, abs(a.grid_import - prediction) AS v FROM fc JOIN hourly a ON a.device_id = fc.device_id AND a.ts_hour = fc.ts_hour WHERE fc.ts_hour BETWEEN s AND e AND a.grid_import IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY device_id) AS n, row_number() OVER (PARTITION BY device_id ORDER BY v) - 1 AS i FROM res),
p AS (SELECT *, least(ceil((n + 1) * CAST(0.5 AS DOUBLE) - 1e-12) / n, 1.0) * (n - 1) AS pos FROM k WHERE n >= 30),
offsets AS (SELECT device_id, sum(CASE WHEN i = floor(pos) THEN (1 - (pos - floor(pos))) * v WHEN i = floor(pos) + 1 THEN (pos - floor(pos)) * v END) AS "offset", max(n) AS n FROM p GROUP BY 1)"""


@query(f'{_OFFSETS} SELECT device_id, round("offset", 6) + 0.0 AS "offset", n FROM offsets')
def i4_pooled_offsets(spark, sf):
    return _offsets(spark, sf)[2]


@query(f"""{_OFFSETS} SELECT device_id, origin, horizon, {r('prediction', 'CASE WHEN o."offset" > 0 THEN greatest(0.0, prediction - o."offset") END AS prediction_lower', 'CASE WHEN o."offset" > 0 THEN prediction + o."offset" END AS prediction_upper')}
FROM fc LEFT JOIN offsets o USING (device_id)""")
def i5_apply_offset(spark, sf):
    _, fc, offsets = _offsets(spark, sf)
    return I.apply_offset(fc, offsets).select("device_id", "origin", "horizon", "prediction", "prediction_lower", "prediction_upper")


_BANDED = f"""WITH {B.LONG}, lagged AS (
  SELECT t.device_id, t.target, t.ts_hour, t.actual AS y, l.actual AS x, CAST(hour((t.ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome') AS INTEGER) AS hr
  FROM actuals t LEFT JOIN actuals l ON l.device_id = t.device_id AND l.target = t.target AND l.ts_hour = t.ts_hour - INTERVAL 168 HOUR WHERE t.actual IS NOT NULL
), part AS (
  SELECT g.*, origin, row_number() OVER own > floor(count(*) OVER every * CAST(0.8 AS DOUBLE)) AS late, count(*) OVER every AS c
  FROM lagged g JOIN origins o ON o.device_id = g.device_id AND g.ts_hour <= o.origin
  WINDOW own AS (PARTITION BY g.device_id, target, origin ORDER BY g.ts_hour), every AS (PARTITION BY g.device_id, target, origin)
), fit AS (
  SELECT device_id, target, origin, regr_slope(y, x) AS s, regr_intercept(y, x) AS i, avg(y) FILTER (x IS NULL) AS m,
    regr_slope(y, x) FILTER (NOT late) AS hs, regr_intercept(y, x) FILTER (NOT late) AS hi, avg(y) FILTER (x IS NULL AND NOT late) AS hm
  FROM part GROUP BY ALL HAVING max(c) * 8 >= 100
), horizons AS (SELECT CAST(h AS INTEGER) AS horizon, CASE WHEN h <= 8 THEN 'short' WHEN h <= 24 THEN 'medium' ELSE 'long' END AS band FROM range(1, 49) r(h)
), fitted AS (
  SELECT device_id, target, origin, band, hr, late, y, greatest(CASE WHEN x IS NULL THEN coalesce(m, i) ELSE i + s * x END, 0.0) AS p, greatest(CASE WHEN x IS NULL THEN coalesce(hm, hi) ELSE hi + hs * x END, 0.0) AS base
  FROM part JOIN fit USING (device_id, target, origin) CROSS JOIN horizons
), shifts AS (
  SELECT device_id, target, origin, band, hr, quantile_cont(y - base, 0.25) AS lo, quantile_cont(y - base, 0.75) AS hi2 FROM fitted WHERE NOT late GROUP BY ALL
), scored AS (
  SELECT f.*, greatest(base + lo - y, y - base - hi2) AS v, quantile_cont(p, 0.5) OVER (PARTITION BY device_id, target, origin, band) AS threshold
  FROM fitted f JOIN shifts USING (device_id, target, origin, band, hr) WHERE late
), ranked AS (
  SELECT *, p > threshold AS active, count(*) OVER (PARTITION BY device_id, target, origin, band, p > threshold) AS n, row_number() OVER (PARTITION BY device_id, target, origin, band, p > threshold ORDER BY v) - 1 AS k FROM scored
), placed AS (SELECT *, least(ceil((n + 1) * CAST(0.5 AS DOUBLE) - 1e-12) / n, 1.0) * (n - 1) AS pos FROM ranked
), q AS (
  SELECT device_id, target, origin, band, max(threshold) AS threshold, active, CASE WHEN max(n) <= 30 THEN 0.0 ELSE sum(CASE WHEN k = floor(pos) THEN (1 - (pos - floor(pos))) * v WHEN k = floor(pos) + 1 THEN (pos - floor(pos)) * v END) END AS q
  FROM placed GROUP BY device_id, target, origin, band, active
), cqr AS (
  SELECT device_id, target, origin, band, max(threshold) AS threshold, coalesce(max(q) FILTER (active), 0.0) AS q_active, coalesce(max(q) FILTER (NOT active), 0.0) AS q_idle FROM q GROUP BY ALL
), ahead AS (
  SELECT f.device_id, f.target, f.origin, horizon, band, f.origin + to_hours(CAST(horizon AS BIGINT)) AS ts_hour, l.actual AS x, f.* EXCLUDE (device_id, target, origin)
  FROM fit f CROSS JOIN horizons LEFT JOIN actuals l ON l.device_id = f.device_id AND l.target = f.target AND l.ts_hour = f.origin + to_hours(CAST(horizon AS BIGINT)) - INTERVAL 168 HOUR
), told AS (
  SELECT a.*, greatest(CASE WHEN x IS NULL THEN coalesce(m, i) ELSE i + s * x END, 0.0) AS prediction, greatest(CASE WHEN x IS NULL THEN coalesce(hm, hi) ELSE hi + hs * x END, 0.0) AS base,
    CAST(hour((ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome') AS INTEGER) AS hr FROM ahead a
), ranges AS (
  SELECT t.device_id, t.target, t.origin, t.horizon, t.ts_hour, prediction, base + lo AS lo, base + hi2 AS hi2, coalesce(CASE WHEN prediction > threshold THEN q_active ELSE q_idle END, 0.0) AS add
  FROM told t LEFT JOIN shifts USING (device_id, target, origin, band, hr) LEFT JOIN cqr USING (device_id, target, origin, band)
), checked AS (
  SELECT b.*, a.actual, CASE WHEN lo IS NOT NULL THEN least(prediction, greatest(0.0, lo - add)) END AS lower, CASE WHEN hi2 IS NOT NULL THEN greatest(prediction, greatest(0.0, hi2 + add)) END AS upper,
    count(*) OVER (PARTITION BY b.device_id, b.target, b.origin) AS n
  FROM ranges b JOIN actuals a ON a.device_id = b.device_id AND a.target = b.target AND a.ts_hour = b.ts_hour WHERE a.actual IS NOT NULL
)"""


@query(f"{_BANDED} SELECT device_id, target, origin, horizon, round(actual, 5) + 0.0 AS actual, round(prediction, 5) + 0.0 AS prediction, round(lower, 5) + 0.0 AS lower, round(upper, 5) + 0.0 AS upper FROM checked WHERE n >= 12")
def i6_interval_backtest(spark, sf):
    """Point, low and high refitted and calibrated at every origin, on the same hour a week before."""
    df = B.stored(B.hourly(spark, sf))

    def backend(history, origins, target):
        return N.interval_backend(N.BandedLinear(CFG, features=[f"{target}_same_hour_7d"], ridge=0.0, store=B.stored))(history, origins, target)

    rows = E.run_backtest(df, CFG, backend)
    return rows.select("device_id", "target", "origin", "horizon", *(B.rounded(c, 5).alias(c) for c in ("actual", "prediction", "lower", "upper")))


@query()
def i7_interval_coverage(spark, sf):
    """The same on the matrix's whole list of features: errors, and the share of hours inside the bounds."""
    df = B.stored(B.hourly(spark, sf))
    return A.metrics(E.run_backtest(df, CFG, N.interval_backend(N.BandedLinear(CFG, store=B.stored))), ["device_id", "target"])


@query(f"""WITH {B.HOURLY}, v(band, h) AS (VALUES ('short', 8), ('medium', 16), ('long', 24)) SELECT device_id, band, count(*) * h AS n, 0.0 AS largest_gap FROM hourly CROSS JOIN v WHERE grid_import IS NOT NULL GROUP BY device_id, band, h""")
def p3_warm_statistics(spark, sf):
    """Statistics of the first three weeks, refreshed twice with what came later: their rows, and the largest gap to a refit's coefficients."""
    df = B.stored(B.hourly(spark, sf).select("device_id", "ts_hour", "grid_import", *CFG.calendar))
    linear = M.GroupedLinear("grid_import", V.resolve_features("grid_import", CFG, True, df.columns), ["device_id", "band"], CFG.ridge)
    held = None
    for end in ("2024-01-22", "2024-01-26 07:00:00", None):
        upto = df if end is None else df.where(F.col("ts_hour") < F.lit(end).cast("timestamp"))
        held = B.stored(W.refreshed(upto, linear, "grid_import", CFG, held, store=B.stored))
    refit = linear.solve(linear.statistics(_matrix(spark, sf, pack=True))).withColumnRenamed("coefficients", "refit")
    both = linear.solve(held).join(refit, linear.by).join(held.select(*linear.by, "n"), linear.by)
    gap = F.array_max(F.zip_with("coefficients", "refit", lambda a, b: F.abs(a - b) / (1 + F.abs(b))))
    return both.select("device_id", "band", "n", F.round(gap, 3).alias("largest_gap"))


@query()
def p2_train_forecast(spark, sf):
    """Readings to records of 48 hours with bounds: gates, fit, cross-validation and forecast in one call."""
    done = N.train_forecast(B.meters(spark, sf), CFG, store=B.stored)
    hours = R.forecasts_to_frame(done["records"])
    errors = done["cv"].groupBy("device_id").agg(*(F.max(F.when(F.col("target") == t, F.col("cv_mae"))).alias(f"{t}_cv_mae") for t in CFG.targets))
    return hours.join(errors, "device_id", "left")


# ------------------------------------------------------------------ records and evaluation

def _forecasts(spark, sf):
    df = B.hourly(spark, sf)
    o = R.forecast_origins(df)
    return M.naive_forecast(df, o, "grid_export", CFG).unionByName(M.naive_forecast(df, o, "grid_import", CFG))


@query(f"""WITH {B.HOURLY}, o AS (SELECT device_id, (SELECT max(ts_hour) FROM hourly) AS origin FROM hourly GROUP BY 1)
SELECT o.device_id, origin AS forecast_origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS "timestamp", round(round(coalesce(x.grid_export, 0.0), 3), 2) + 0.0 AS grid_export_kwh
FROM o CROSS JOIN range(1, 49) r(h) LEFT JOIN hourly x ON x.device_id = o.device_id AND x.ts_hour = origin + to_hours(CAST(h AS BIGINT)) - INTERVAL 168 HOUR""")
def k4_forecasts_to_frame(spark, sf):
    flat = R.forecasts_to_frame(R.forecast_records(_forecasts(spark, sf)))
    return flat.select("device_id", "forecast_origin", "horizon", "timestamp", B.rounded("grid_export_kwh", 2).alias("grid_export_kwh"))


_FLAT = f"""WITH {B.HOURLY}, o AS (SELECT device_id, (SELECT max(ts_hour) FROM hourly) AS origin FROM hourly GROUP BY 1), flat AS (
  SELECT o.device_id, origin, CAST(h AS INTEGER) AS horizon, origin + to_hours(CAST(h AS BIGINT)) AS "timestamp", round(coalesce(x.grid_export, 0.0), 3) AS grid_export_kwh, round(coalesce(x.grid_import, 0.0), 3) AS grid_import_kwh,
    round(round(coalesce(x.grid_export, 0.0), 3) - round(coalesce(x.grid_import, 0.0), 3), 3) AS net_exchange_kwh
  FROM o CROSS JOIN range(1, 49) r(h) LEFT JOIN hourly x ON x.device_id = o.device_id AND x.ts_hour = origin + to_hours(CAST(h AS BIGINT)) - INTERVAL 168 HOUR)"""


@query(f"""{_FLAT} SELECT device_id, origin AS forecast_origin, CAST(count(*) AS INTEGER) AS n, min("timestamp") AS first_hour, max("timestamp") AS last_hour, string_agg(CAST(horizon AS VARCHAR), ' ' ORDER BY horizon) AS horizons,
  {r('sum(grid_export_kwh) AS export_kwh', 'sum(grid_import_kwh) AS import_kwh')} FROM flat GROUP BY 1, 2""")
def r1_forecast_records(spark, sf):
    """One nested record a device: its hours in order, and what its array holds in all."""
    records = R.forecast_records(_forecasts(spark, sf))
    add = lambda c: F.aggregate(f"forecasts.{c}", F.lit(0.0), lambda a, x: a + x)
    ends = [F.element_at("forecasts", i)["timestamp"].alias(n) for i, n in ((1, "first_hour"), (-1, "last_hour"))]
    return records.select("device_id", "forecast_origin", F.size("forecasts").alias("n"), *ends, F.array_join("forecasts.horizon", " ").alias("horizons"), add("grid_export_kwh").alias("export_kwh"), add("grid_import_kwh").alias("import_kwh"))


@query(f"{_FLAT} SELECT device_id, origin, horizon, \"timestamp\", {r('grid_export_kwh', 'grid_import_kwh', 'net_exchange_kwh')} FROM flat")
def r2_batch_score(spark, sf):
    return R.batch_score(B.meters(spark, sf), CFG, E.naive_backend(CFG))


@query(f"WITH {B.LONG} SELECT device_id, origin FROM origins")
def e1_origins(spark, sf):
    return E.backtest_origins(B.hourly(spark, sf), CFG)


#: told: forecasts of the two-input line that is fitted anew at each of the origins ``asked``.
_TOLD = f"""clocked AS (SELECT a.*, h.hour_sin, h.hour_cos FROM actuals a JOIN hourly h USING (device_id, ts_hour)),
moments AS (SELECT o.device_id, c.target, o.origin, {_LINE} FROM (SELECT DISTINCT device_id, origin FROM asked) o JOIN (SELECT *, actual AS y FROM clocked WHERE actual IS NOT NULL) c ON c.device_id = o.device_id AND c.ts_hour <= o.origin GROUP BY ALL),
line AS (SELECT device_id, target, origin, {_SLOPES} FROM moments),
told AS (SELECT l.device_id, l.target, l.origin, CAST(h AS INTEGER) AS horizon, c.ts_hour, c.actual, greatest(i + s * hour_sin + c * hour_cos, 0.0) AS prediction
  FROM line l CROSS JOIN range(1, 49) r(h) JOIN clocked c ON c.device_id = l.device_id AND c.target = l.target AND c.ts_hour = l.origin + to_hours(CAST(h AS BIGINT)) WHERE c.actual IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY l.device_id, l.target, l.origin) >= 12)"""


def _two_inputs():
    return E.linear_backend(CFG, features=_CLOCK, ridge=0.0)


@query(f"WITH {B.LONG}, asked AS (SELECT * FROM origins), {_TOLD} SELECT device_id, target, origin, horizon, {r('actual')}, round(prediction, 5) + 0.0 AS prediction FROM told")
def e2_two_inputs(spark, sf):
    """The linear backtest on two inputs, refitted at every origin."""
    rows = E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, _two_inputs())
    return rows.select("device_id", "target", "origin", "horizon", "actual", B.rounded("prediction", 5).alias("prediction"))


@query()
def e2_linear_backtest(spark, sf):
    bt = E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, E.linear_backend(CFG))
    return A.metrics(bt.drop("lower", "upper"), ["device_id", "target"])


@query()
def e3_pooled_backtest(spark, sf):
    df = B.stored(B.hourly(spark, sf))
    bt = E.run_backtest(df, CFG, E.linear_backend(CFG, pooled=df.select("device_id").distinct()))
    return A.metrics(bt.drop("lower", "upper"), ["device_id", "target"])


@query()
def e3_forest_backtest(spark, sf):
    """One forest of all devices for each band, fitted every ten days on what was known then: errors and coverage of its bounds."""
    forest = lambda target, features: QuantileForest(target, features, trees=20, depth=6, store=B.stored)
    return A.metrics(E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, BK.refitting(CFG, forest, 240, store=B.stored)), ["device_id", "target"])


@query()
def e4_cross_validate(spark, sf):
    return E.cross_validate(B.stored(B.hourly(spark, sf)), CFG, E.linear_backend(CFG))


_CV = f"""WITH {B.LONG}, folds AS (SELECT device_id, a, b - to_hours(CAST(168 * f AS BIGINT)) AS s, b - to_hours(CAST(168 * f AS BIGINT)) + to_hours(CAST(24 * k AS BIGINT)) AS origin FROM ends, range(1, 5) x(f), range(0, 6) y(k)),
ok AS (SELECT f.device_id, f.origin, t.target FROM folds f JOIN actuals t ON t.device_id = f.device_id AND t.ts_hour > f.s AND t.ts_hour <= f.s + INTERVAL 168 HOUR WHERE t.actual IS NOT NULL AND f.origin > f.a GROUP BY ALL HAVING count(DISTINCT t.ts_hour) >= 24),
p AS (SELECT ok.*, c.actual, greatest(coalesce(l.actual, 0.0), 0.0) AS prediction FROM ok CROSS JOIN range(1, 49) r(h) JOIN actuals c ON c.device_id = ok.device_id AND c.target = ok.target AND c.ts_hour = origin + to_hours(CAST(h AS BIGINT))
  JOIN actuals l ON l.device_id = ok.device_id AND l.target = ok.target AND l.ts_hour = c.ts_hour - INTERVAL 168 HOUR WHERE c.actual IS NOT NULL),
e AS (SELECT device_id, target, origin, avg(abs(prediction - actual)) AS m FROM p GROUP BY ALL HAVING count(*) >= 12)
SELECT device_id, target, {r('avg(m) AS cv_mae', 'avg(m) AS naive_mae')}, count(*) AS n_origins FROM e GROUP BY 1, 2"""


@query(f"""{_CV[: _CV.index("p AS (SELECT")]}asked AS (SELECT DISTINCT device_id, origin FROM folds WHERE origin > a), {_TOLD},
e AS (SELECT device_id, target, origin, avg(abs(prediction - actual)) AS m FROM told JOIN ok USING (device_id, target, origin) GROUP BY ALL)
SELECT device_id, target, round(avg(m), 5) + 0.0 AS cv_mae, count(*) AS n_origins FROM e GROUP BY 1, 2""")
def e4_two_inputs(spark, sf):
    """Cross-validation of the two-input line."""
    done = E.cross_validate(B.stored(B.hourly(spark, sf)), CFG, _two_inputs())
    return done.select("device_id", "target", B.rounded("cv_mae", 5).alias("cv_mae"), "n_origins")


@query(_CV)
def e5_naive_cv(spark, sf):
    return E.cross_validate(B.hourly(spark, sf), CFG, E.naive_backend(CFG)).drop("skill")


@query(f"""WITH {B.STEPS}, m AS (SELECT t.target, regr_slope(t.actual, l.actual) AS slope, regr_intercept(t.actual, l.actual) AS intercept
  FROM actuals t JOIN actuals l ON l.device_id = t.device_id AND l.target = t.target AND l.ts_hour = t.ts_hour - INTERVAL 168 HOUR GROUP BY 1),
folds AS (SELECT DISTINCT device_id, b - to_hours(CAST(168 * f AS BIGINT)) + to_hours(CAST(24 * k AS BIGINT)) AS origin, a FROM ends, range(1, 5) x(f), range(0, 6) y(k)),
p AS (SELECT f.device_id, m.target, f.origin, c.actual, greatest(intercept + slope * l.actual, 0.0) AS prediction FROM folds f CROSS JOIN range(1, 49) r(h) JOIN actuals c ON c.device_id = f.device_id AND c.ts_hour = f.origin + to_hours(CAST(h AS BIGINT))
  JOIN actuals l ON l.device_id = c.device_id AND l.target = c.target AND l.ts_hour = c.ts_hour - INTERVAL 168 HOUR JOIN m ON m.target = c.target WHERE f.origin > f.a AND c.actual IS NOT NULL AND l.actual IS NOT NULL),
e AS (SELECT device_id, target, origin, avg(abs(prediction - actual)) AS v FROM p GROUP BY ALL HAVING count(*) >= 12)
SELECT device_id, target, {r('avg(v) AS cv_mae')}, count(*) AS n_origins FROM e GROUP BY 1, 2""")
def e5_pooled_cv(spark, sf):
    """One seasonal line for the whole pool, fitted once."""
    df = B.stored(B.hourly(spark, sf))
    return E.pooled_cv(df, CFG, E.pooled_seasonal_backend(df, CFG))


_POOLED = f"""WITH {B.HOURLY}, clean AS (SELECT * FROM hourly WHERE NOT (grid_export_outlier OR grid_import_outlier)
), gates AS (SELECT device_id, avg(grid_export) >= 0.01 AS gives, avg(grid_import) >= 0.01 AS takes FROM clean GROUP BY 1
), pooled AS (
  SELECT device_id, ts_hour, hour_sin, hour_cos, 'grid_export' AS target, grid_export AS y FROM clean WHERE device_id IN (SELECT device_id FROM gates WHERE gives) AND device_id <> 'dev-3'
  UNION ALL SELECT device_id, ts_hour, hour_sin, hour_cos, 'grid_import', grid_import FROM clean WHERE device_id IN (SELECT device_id FROM gates WHERE takes) AND device_id <> 'dev-3'
), dealt AS (SELECT *, row_number() OVER (PARTITION BY device_id, target ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id, target) AS n FROM pooled
), members AS (
  SELECT device_id, target, min(ts_hour) FILTER (k > (n * 70) // 100 AND k <= (n * 85) // 100) AS first_hour, max(ts_hour) FILTER (k > (n * 70) // 100 AND k <= (n * 85) // 100) AS last_hour
  FROM dealt GROUP BY 1, 2 HAVING count(*) >= 336 + 48 AND first_hour IS NOT NULL AND count(y) FILTER (k <= (n * 70) // 100) > 0
), moments AS (SELECT target, {_LINE} FROM dealt JOIN members USING (device_id, target) WHERE ts_hour < first_hour AND y IS NOT NULL GROUP BY 1
), line AS (SELECT target, {_SLOPES} FROM moments
), told AS (SELECT p.*, first_hour, last_hour, greatest(i + s * hour_sin + c * hour_cos, 0.0) AS prediction FROM pooled p JOIN members USING (device_id, target) JOIN line USING (target)
), residuals AS (
  SELECT device_id, target, abs(y - prediction) AS v, count(*) OVER (PARTITION BY device_id, target) AS n, row_number() OVER (PARTITION BY device_id, target ORDER BY abs(y - prediction)) - 1 AS k
  FROM told WHERE ts_hour BETWEEN first_hour AND last_hour AND y IS NOT NULL
), placed AS (SELECT *, least(ceil((n + 1) * CAST(0.5 AS DOUBLE) - 1e-12) / n, 1.0) * (n - 1) AS pos FROM residuals WHERE n >= 30
), shifts AS (SELECT device_id, target, sum(CASE WHEN k = floor(pos) THEN (1 - (pos - floor(pos))) * v WHEN k = floor(pos) + 1 THEN (pos - floor(pos)) * v END) AS shift FROM placed GROUP BY 1, 2
), spans AS (SELECT device_id, min(ts_hour) AS a, max(ts_hour) AS b FROM clean GROUP BY 1
), folds AS (SELECT DISTINCT device_id, b - to_hours(CAST(168 * f AS BIGINT)) + to_hours(CAST(24 * d AS BIGINT)) AS origin, a FROM spans, range(1, 5) x(f), range(0, 6) z(d)
), whole AS (SELECT f.device_id, f.origin FROM folds f JOIN clean h ON h.device_id = f.device_id AND h.ts_hour > f.origin AND h.ts_hour <= f.origin + INTERVAL 48 HOUR WHERE f.origin > f.a GROUP BY ALL HAVING count(*) >= 24
), errors AS (
  SELECT t.device_id, t.target, w.origin, avg(abs(prediction - y)) AS e FROM whole w JOIN told t ON t.device_id = w.device_id AND t.ts_hour > w.origin AND t.ts_hour <= w.origin + INTERVAL 48 HOUR
  WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 12
), cv AS (SELECT device_id, target, avg(e) AS cv_mae FROM errors GROUP BY 1, 2
), steps AS (
  SELECT device_id, target, (SELECT max(ts_hour) FROM hourly) AS origin, CAST(h AS INTEGER) AS horizon, (SELECT max(ts_hour) FROM hourly) + to_hours(CAST(h AS BIGINT)) AS ts_hour
  FROM members, range(1, 49) z(h)
), clocked AS (SELECT *, hour((ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome') AS h FROM steps
), ahead AS (SELECT p.*, greatest(i + s * sin(2 * pi() * h / 24) + c * cos(2 * pi() * h / 24), 0.0) AS prediction, shift FROM clocked p JOIN line USING (target) LEFT JOIN shifts USING (device_id, target))"""


@query(f"""{_POOLED} SELECT device_id, target, origin, horizon, ts_hour, round(prediction, 5) + 0.0 AS prediction, round(CASE WHEN shift > 0 THEN greatest(0.0, prediction - shift) END, 5) + 0.0 AS lower,
  round(CASE WHEN shift > 0 THEN prediction + shift END, 5) + 0.0 AS upper, round(cv_mae, 5) + 0.0 AS cv_mae FROM ahead LEFT JOIN cv USING (device_id, target)""")
def p4_pooled(spark, sf):
    """One line for the pool on two inputs, saved and read again: a device left out, bounds of each member's own, cross-validation and forecasts."""
    train, backend, told = _pooled(spark, sf)
    cv = E.pooled_cv(train, CFG, backend).select("device_id", "target", "cv_mae")
    rows = told.join(cv, ["device_id", "target"], "left")
    return rows.select("device_id", "target", "origin", "horizon", "ts_hour", *(B.rounded(c, 5).alias(c) for c in ("prediction", "lower", "upper", "cv_mae")))


def _pooled(spark, sf):
    """Training rows, and a saved pool's backend and forecasts."""
    hourly = B.stored(B.hourly(spark, sf))
    train = B.stored(V.remove_outliers(hourly))
    pooled = P.PooledLinear(CFG, {t: _CLOCK for t in CFG.targets}, ridge=0.0, store=B.stored)
    gone = spark.createDataFrame([("dev-3",)], "device_id string")
    path = B.fresh_path(spark)
    P.save_pool(pooled.fit(train, V.target_gate(V.activity_gates(train, CFG)), gone), pooled, path, train.columns)
    again, pool = P.load_pool(spark, path, CFG)
    backend, starts = again.backend(pool), R.forecast_origins(hourly)
    return train, backend, backend(hourly, starts, CFG.targets[0]).unionByName(backend(hourly, starts, CFG.targets[1]))


@query(f"""WITH {B.LONG}, asked AS (SELECT * FROM origins), {_TOLD.replace("c.device_id = o.device_id AND c.ts_hour <=", "c.device_id <> o.device_id AND c.ts_hour <=")}
SELECT device_id, target, origin, horizon, {r('actual')}, round(prediction, 5) + 0.0 AS prediction FROM told""")
def e3_leave_one_out(spark, sf):
    """Each device forecast by a two-input line of all other devices, refitted at every origin."""
    rows = E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, P.leave_one_out_backend(CFG, _CLOCK, 0.0, store=B.stored))
    return rows.select("device_id", "target", "origin", "horizon", "actual", B.rounded("prediction", 5).alias("prediction"))


@query(f"""WITH {B.LONG}, f AS (SELECT e.device_id, e.b - INTERVAL 48 HOUR + to_hours(CAST(h AS BIGINT)) AS ts_hour FROM ends e, range(1, 49) r(h)),
j AS (SELECT f.device_id, a.target, abs(greatest(coalesce(l.actual, 0.0), 0.0) - a.actual) AS e FROM f JOIN actuals a ON a.device_id = f.device_id AND a.ts_hour = f.ts_hour
  JOIN actuals l ON l.device_id = f.device_id AND l.target = a.target AND l.ts_hour = f.ts_hour - INTERVAL 168 HOUR WHERE a.actual IS NOT NULL)
SELECT device_id, target, {r('avg(e) AS mae')} FROM j GROUP BY 1, 2 HAVING count(*) >= 12""")
def e6_quick_train_mae(spark, sf):
    return E.quick_train_mae(B.hourly(spark, sf), CFG, E.naive_backend(CFG))


@query(f"WITH {B.STEPS} SELECT device_id, target, origin, horizon, {r('actual', 'prediction')} FROM backtest")
def e7_naive_backtest(spark, sf):
    return _backtest(spark, sf).select("device_id", "target", "origin", "horizon", "actual", "prediction")


def _candidates(spark, sf):
    """Two naive backends: a week back, and two days back (for all hours that this leaves before the origin)."""
    df = B.stored(B.hourly(spark, sf))
    rows = None
    for name, lag in (("naive", 168), ("two_days", 48)):
        part = E.run_backtest(df, CFG, E.naive_backend(CFG, lag)).withColumn("candidate", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return B.stored(rows.select("candidate", "device_id", "target", "origin", "horizon", "ts_hour", "actual", "prediction"))


_CAND = f"""WITH {B.STEPS}, both_naive AS (SELECT *, 'naive' AS candidate FROM backtest UNION ALL SELECT *, 'two_days' FROM (
  SELECT s.device_id, a.target, s.origin, s.ts_hour, s.horizon, greatest(coalesce(a.actual, 0.0), 0.0) AS prediction, c.actual FROM steps s
  JOIN actuals a ON a.device_id = s.device_id AND a.ts_hour = s.ts_hour - INTERVAL 48 HOUR JOIN actuals c ON c.device_id = s.device_id AND c.target = a.target AND c.ts_hour = s.ts_hour
  WHERE c.actual IS NOT NULL QUALIFY count(*) OVER (PARTITION BY s.device_id, a.target, s.origin) >= 12)),
per AS (SELECT candidate, device_id, target, origin, avg(abs(prediction - actual)) AS mae FROM both_naive GROUP BY ALL),
cells AS (SELECT device_id, target, origin FROM per GROUP BY ALL HAVING count(DISTINCT candidate) = (SELECT count(DISTINCT candidate) FROM per))"""
_COMPARED = f"{_CAND}, cmp AS (SELECT candidate, avg(abs(prediction - actual)) AS mae, sqrt(avg((prediction - actual) ** 2)) AS rmse, avg(prediction - actual) AS mbe, count(*) AS n_rows FROM both_naive JOIN cells USING (device_id, target, origin) GROUP BY 1)"


@query(f"{_CAND} SELECT candidate, device_id, target, origin, {r('mae')} FROM per")
def e8_per_origin(spark, sf):
    return E.per_origin_mae(_candidates(spark, sf))


@query(f"{_CAND} SELECT * FROM cells")
def e9_common_cells(spark, sf):
    return E.common_cells(E.per_origin_mae(_candidates(spark, sf)))


@query(f"{_COMPARED} SELECT candidate, {r('mae', 'rmse', 'mbe')}, n_rows, {r('1 - mae / (SELECT mae FROM cmp WHERE candidate = $$naive$$) AS skill_vs_naive')} FROM cmp")
def e10_comparison(spark, sf):
    rows = _candidates(spark, sf)
    return E.comparison(rows, E.common_cells(E.per_origin_mae(rows)))


@query(f"{_COMPARED} SELECT CASE WHEN (SELECT min(mae) FROM cmp WHERE candidate <> 'naive') < (SELECT mae FROM cmp WHERE candidate = 'naive') THEN 'two_days' ELSE 'naive' END AS winner")
def e11_winner(spark, sf):
    rows = _candidates(spark, sf)
    return E.pick_winner(E.comparison(rows, E.common_cells(E.per_origin_mae(rows))))


@query()
def e12_benchmark(spark, sf):
    return E.benchmark(B.stored(B.hourly(spark, sf)), CFG, {"linear": E.linear_backend(CFG)}, store=B.stored)["comparison"]


@query(f"""WITH {B.STEPS}, asked AS (SELECT * FROM origins), {_TOLD}, every AS (SELECT 'naive' AS candidate, device_id, target, origin, actual, prediction FROM backtest UNION ALL SELECT 'linear', device_id, target, origin, actual, prediction FROM told),
cells AS (SELECT device_id, target, origin FROM every GROUP BY ALL HAVING count(DISTINCT candidate) = 2),
cmp AS (SELECT candidate, avg(abs(prediction - actual)) AS mae, sqrt(avg((prediction - actual) ** 2)) AS rmse, avg(prediction - actual) AS mbe, count(*) AS n_rows FROM every JOIN cells USING (device_id, target, origin) GROUP BY 1)
SELECT candidate, round(mae, 5) + 0.0 AS mae, round(rmse, 5) + 0.0 AS rmse, round(mbe, 5) + 0.0 AS mbe, n_rows, round(1 - mae / (SELECT mae FROM cmp WHERE candidate = 'naive'), 5) + 0.0 AS skill_vs_naive FROM cmp""")
def e12_two_inputs(spark, sf):
    """The benchmark of the two-input line against the naive forecast."""
    done = E.benchmark(B.stored(B.hourly(spark, sf)), CFG, {"linear": _two_inputs()}, store=B.stored)["comparison"]
    return done.select("candidate", "n_rows", *(B.rounded(c, 5).alias(c) for c in ("mae", "rmse", "mbe", "skill_vs_naive")))


@query(f"WITH {B.STEPS} SELECT device_id, target, {r('avg(abs(prediction - actual)) AS mae', 'sqrt(avg((prediction - actual) ** 2)) AS rmse', 'avg(CAST(actual BETWEEN prediction * 0.5 AND prediction * 1.5 AS DOUBLE)) AS coverage')}, count(*) AS n_hours FROM joined WHERE n >= 0 GROUP BY 1, 2")
def e13_evaluate(spark, sf):
    df = B.hourly(spark, sf)
    o = E.backtest_origins(df, CFG)
    fc = M.naive_forecast(df, o, "grid_export", CFG).unionByName(M.naive_forecast(df, o, "grid_import", CFG)).where("prediction is not null")
    fc = fc.withColumns({"prediction_lower": F.col("prediction") * 0.5, "prediction_upper": F.col("prediction") * 1.5})
    return E.evaluate_forecasts(fc, J.long_targets(df, CFG.targets))


# ------------------------------------------------------------------ run log

def _runs(spark, sf):
    """Orders as runs: a customer is a device, an order a run with its price as an error."""
    o = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), F.concat(F.lit("dev-"), (F.col("o_custkey") % 50).cast("string")).alias("device_id"), F.col("o_orderdate").cast("timestamp").alias("start_time"), F.col("o_totalprice").cast("double").alias("price"))
    return o.select("run_id", "device_id", "start_time"), o.select("run_id", F.lit("cv_mae_import").alias("key"), F.col("price").alias("value"))


_RUNS = "WITH runs AS (SELECT o_orderkey AS run_id, 'dev-' || CAST(o_custkey % 50 AS VARCHAR) AS device_id, CAST(o_orderdate AS TIMESTAMP) AS start_time, CAST(o_totalprice AS DOUBLE) AS price FROM orders)"


@query(f"""{_RUNS}, l AS (SELECT *, lag(price) OVER (PARTITION BY device_id ORDER BY start_time, run_id) AS prev FROM runs)
SELECT device_id, 'cv_mae_import' AS key, run_id, {r('prev AS previous', 'price AS current', '(price - prev) / prev AS change')}, (price - prev) / prev > CAST(0.15 AS DOUBLE) AS degraded FROM l WHERE prev > 0""")
def e14_drift(spark, sf):
    return E.drift(*_runs(spark, sf))


@query(f"{_RUNS} SELECT run_id, device_id, start_time FROM runs QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY start_time DESC, run_id DESC) = 1")
def l2_latest_run(spark, sf):
    return L.latest_run(_runs(spark, sf)[0])


@query(f"{_RUNS} SELECT run_id, device_id, start_time FROM runs WHERE NOT start_time < TIMESTAMP '1998-01-01' - INTERVAL 365 DAY")
def l3_prune_runs(spark, sf):
    return L.prune_runs(_runs(spark, sf)[0], 365, "1998-01-01")


@query("SELECT n_name AS \"table\", coalesce(CASE WHEN n_regionkey > 1 THEN 'CC-BY' END, 'unknown') AS license, 'green' AS classification, 'region-' || n_regionkey AS owner, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'meters' END, 'unknown') AS source_system FROM nation WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_7')")
def l4_lineage(spark, sf):
    n = B.table(spark, sf, "nation")
    registry = n.select(F.col("n_name").alias("table"), F.when(F.col("n_regionkey") > 1, "CC-BY").alias("license"), F.lit(None).cast("string").alias("classification"), F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("owner"), F.when(F.col("n_nationkey") % 2 == 0, "meters").alias("source_system"))
    return L.lineage_tags(spark, ["NATION_1", "NATION_2", "NATION_7", "nowhere"], registry)


@query("""WITH reads AS (SELECT DISTINCT o_orderkey AS run_id, n_name AS t, n_nationkey AS k, n_regionkey AS g FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT run_id, 'input.' || t || '.license' AS key, CASE WHEN g > 1 THEN 'CC-BY' ELSE 'unknown' END AS value FROM reads WHERE k % 5 > 0
UNION ALL SELECT run_id, 'input.' || t || '.classification', CASE WHEN k % 4 = 0 THEN 'amber' ELSE 'green' END FROM reads WHERE k % 5 > 0
UNION ALL SELECT run_id, 'input.' || t || '.source_system', CASE WHEN k % 2 = 0 THEN 'meters' ELSE 'unknown' END FROM reads WHERE k % 5 > 0
UNION ALL SELECT run_id, 'input.' || t || '.owner', 'region-' || g FROM reads WHERE k % 5 > 0 AND k % 3 > 0
UNION ALL SELECT run_id, v.key, v.value FROM (SELECT DISTINCT run_id FROM reads), (VALUES ('license', 'CC0'), ('source_url', 'here'), ('owner.steward', 'b')) v(key, value)""")
def l4_run_tags(spark, sf):
    """Tags of each run from the tables that it read; every fifth table isn't in the registry, every third has no owner."""
    n = B.table(spark, sf, "nation")
    customers = B.table(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    reads = B.table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("run_id"), F.col("n_name").alias("table"))
    key, region = F.col("n_nationkey"), F.concat(F.lit("region-"), F.col("n_regionkey").cast("string"))
    owner = lambda kind, name: F.struct(F.lit(kind).alias("type"), name.alias("name"))
    registry = n.where(key % 5 > 0).select(
        F.col("n_name").alias("table"), F.when(F.col("n_regionkey") > 1, "CC-BY").alias("license"), F.when(key % 4 == 0, "amber").alias("classification"), F.when(key % 2 == 0, "meters").alias("source_system"),
        F.when(key % 3 > 0, F.array(owner("owner", region), owner("steward", F.lit("x")))).alias("ownership"),
    )
    return L.run_tags(reads, registry, {"license": "CC0", "source_url": "here"}, [("steward", "a"), ("steward", "b")])


@query("SELECT run_id, device_id, start_time FROM (" + _RUNS + " SELECT * FROM runs WHERE device_id = 'dev-7') t")
def l3_list_runs(spark, sf):
    return L.list_runs(_runs(spark, sf)[0], "dev-7")


@query(f"{_RUNS} SELECT run_id, 'cv_mae_import' AS key, {r('price AS value')} FROM runs WHERE run_id % 3 > 0")
def l1_log_runs(spark, sf):
    """Metrics written to the log and read again; nulls and NaNs stay out."""
    m = _runs(spark, sf)[1]
    gaps = F.when(F.col("run_id") % 3 == 0, F.when(F.col("run_id") % 2 == 0, F.lit(float("nan")))).otherwise(F.col("value"))
    path = B.fresh_path(spark)
    L.log_runs(L.clean_metrics(m.withColumn("value", gaps)).withColumn("session", F.col("run_id") % 4), path)
    return spark.read.parquet(path).select("run_id", "key", "value")


# ------------------------------------------------------------------ domains other than meters

@query("""WITH d AS (SELECT l_returnflag AS device_id, date_trunc('month', CAST(l_shipdate AS TIMESTAMP)) AS ts_hour, sum(CAST(l_quantity AS DOUBLE)) AS grid_import FROM lineitem GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts_hour) AS k, count(*) OVER (PARTITION BY device_id) AS c FROM d)
SELECT device_id, CASE WHEN k <= (c * 70) // 100 THEN 'train' WHEN k <= (c * 85) // 100 THEN 'valid' ELSE 'test' END AS split, round(sum(grid_import), 2) + 0.0 AS quantity, count(*) AS n FROM n GROUP BY ALL""")
def d1_lineitem_domain(spark, sf):
    d = B.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("device_id"), F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("ts_hour")).agg(F.sum(F.col("l_quantity").cast("double")).alias("q"))
    return X.split_70_15_15(d).groupBy("device_id", "split").agg(B.rounded(F.sum("q"), 2).alias("quantity"), F.count(F.lit(1)).alias("n"))


@query("""WITH hourly AS (SELECT event_type AS device_id, date_trunc('hour', ts) AS ts_hour, sum(value) AS grid_export, CAST(count(*) AS DOUBLE) AS grid_import FROM events GROUP BY ALL)"""
    + B.STEPS[len(B.HOURLY):] + f""" SELECT device_id AS event_type, CASE target WHEN 'grid_export' THEN 'total' ELSE 'number' END AS target, origin, horizon, ts_hour AS hour, {r('actual', 'prediction')} FROM backtest""")
def d2_event_domain(spark, sf):
    """The naive backtest of hourly events by type: another entity, time and targets."""
    roles = Roles("event_type", "hour", ("total", "number"))
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    df = B.table(spark, sf, "events").groupBy("event_type", hour.alias("hour")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).cast("double").alias("number"))
    cfg = roles.settings(CFG)
    rows = roles.own(E.run_backtest(B.stored(roles.standard(df)), cfg, E.naive_backend(cfg)))
    return rows.select("event_type", "target", "origin", "horizon", "hour", "actual", "prediction")


# ------------------------------------------------------------------ streams and user functions

def _readings_stream(spark, sf, *more):
    kind = B.table(spark, sf, "events").schema
    e = spark.readStream.schema(kind).parquet(f"{sf}/events.parque[t]")  # a pattern: the table may be one file
    takes, gives = F.col("event_type").isin("click", "view", "signup"), F.col("event_type").isin("purchase", "error")
    return e.select(
        S.meter_of(F.col("user_id"), B.USERS).alias("device_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.when(takes, F.col("value")).otherwise(0.0).alias("consumption_kwh"), F.when(gives, F.col("value")).otherwise(0.0).alias("production_kwh"), *more,
    )


@query(f"""WITH e AS (SELECT DISTINCT ON (user_id // {B.USERS}, ts) 'dev-' || CAST(user_id // {B.USERS} AS VARCHAR) AS device_id, ts, event_type, value FROM events
  ORDER BY user_id // {B.USERS}, ts, event_id DESC),
h AS (SELECT device_id, date_trunc('hour', ts) AS ts_hour, count(*) AS n_quarters, sum(CASE WHEN event_type IN ('click', 'view', 'signup') THEN value ELSE 0 END) AS c FROM e GROUP BY ALL)
SELECT device_id, ts_hour, n_quarters, {r('c * CASE WHEN n_quarters < 4 THEN CAST(4 AS DOUBLE) / n_quarters ELSE 1.0 END AS M1_cons')} FROM h WHERE ts_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def t1_stream_last(spark, sf):
    """Of repeated readings the last counts (that of the largest event), once the watermark has passed its hour."""
    path, mark, store = B.fresh_path(spark), B.fresh_path(spark), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store, None)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        last = T.stream_last_readings(_readings_stream(spark, sf, "event_id"), "event_id")
        last.writeStream.outputMode("append").option("checkpointLocation", mark).trigger(availableNow=True).format("parquet").start(path).awaitTermination()
    finally:
        spark.conf.unset(store) if before is None else spark.conf.set(store, before)
    return C.hourly_rollup(spark.read.schema(last.schema).parquet(path), CFG).select("device_id", "ts_hour", "n_quarters", "M1_cons")


@query(f"""WITH {B.LONG}, fits AS (SELECT o.device_id, t.target, o.origin, avg(t.actual) AS m FROM origins o JOIN actuals t ON t.device_id = o.device_id AND t.ts_hour <= o.origin AND t.ts_hour > o.origin - INTERVAL 240 HOUR WHERE t.actual IS NOT NULL GROUP BY ALL),
told AS (SELECT f.device_id, f.target, f.origin, CAST(h AS INTEGER) AS horizon, t.actual, greatest(m, 0.0) AS prediction FROM fits f CROSS JOIN range(1, 49) r(h)
  JOIN actuals t ON t.device_id = f.device_id AND t.target = f.target AND t.ts_hour = f.origin + to_hours(CAST(h AS BIGINT)) WHERE t.actual IS NOT NULL QUALIFY count(*) OVER (PARTITION BY f.device_id, f.target, f.origin) >= 12)
SELECT device_id, target, origin, horizon, {r('actual', 'prediction')} FROM told""")
def u1_own_model(spark, sf):
    """A user's Python model a device, refitted at every origin on its last ten days: here their mean."""
    own = BK.per_device(CFG, lambda x, y: float(y.mean()), lambda model, x: [model] * len(x), history_days=10)
    return E.run_backtest(B.stored(B.hourly(spark, sf)), CFG, own).select("device_id", "target", "origin", "horizon", "actual", "prediction")


@query(f"""WITH e AS (SELECT DISTINCT ON (user_id // {B.USERS}, ts) 'dev-' || CAST(user_id // {B.USERS} AS VARCHAR) AS device_id, ts, event_type, value FROM events),
h AS (SELECT device_id, date_trunc('hour', ts) AS ts_hour, count(*) AS n_quarters, sum(CASE WHEN event_type IN ('click', 'view', 'signup') THEN value ELSE 0 END) AS c FROM e GROUP BY ALL)
SELECT device_id, ts_hour, n_quarters, {r('c * CASE WHEN n_quarters < 4 THEN CAST(4 AS DOUBLE) / n_quarters ELSE 1.0 END AS M1_cons')} FROM h WHERE ts_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def t1_stream_hourly(spark, sf):
    path, mark = B.fresh_path(spark), B.fresh_path(spark)
    stream = T.stream_hourly(_readings_stream(spark, sf), CFG)
    run = stream.writeStream.outputMode("append").option("checkpointLocation", mark).trigger(availableNow=True).format("parquet").start(path)
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select("device_id", "ts_hour", "n_quarters", "M1_cons")


@query(f"WITH {B.STEPS} SELECT device_id, target, origin, horizon, {r('actual', 'prediction', 'prediction - actual AS error')} FROM joined WHERE n >= 0")
def t2_stream_score(spark, sf):
    df = B.hourly(spark, sf)
    actual_path, path, mark = B.fresh_path(spark), B.fresh_path(spark), B.fresh_path(spark)
    actuals = J.long_targets(df, CFG.targets)
    actuals.write.parquet(actual_path)
    o = E.backtest_origins(df, CFG)
    fc = M.naive_forecast(df, o, "grid_export", CFG).unionByName(M.naive_forecast(df, o, "grid_import", CFG)).where("prediction is not null")
    T.stream_score_actuals(spark.readStream.schema(actuals.schema).parquet(actual_path), fc, path, mark).awaitTermination()
    return spark.read.parquet(path).select("device_id", "target", "origin", "horizon", "actual", "prediction", "error")


@query(f"""WITH {B.HOURLY} SELECT device_id, count(*) * 48 AS n_stream, 48 * round(sum(grid_import * grid_import), 3) + 0.0 AS yy_stream, 0.0 AS gap FROM hourly WHERE grid_import IS NOT NULL GROUP BY 1""")
def t3_stream_model_update(spark, sf):
    """Statistics gathered by a stream, and how far they are from those of one batch."""
    matrix = _matrix(spark, sf, pack=True)
    rows_path, path, mark = B.fresh_path(spark), B.fresh_path(spark), B.fresh_path(spark)
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # by day and not at random: arrays of one device's hours beside each other take little room, and each device is in both batches
    matrix.repartition(files, "device_id", F.to_date("ts_hour")).write.parquet(rows_path)
    linear = M.GroupedLinear("grid_import", _inputs(matrix), ["device_id"])
    stream = spark.readStream.schema(matrix.schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(rows_path)
    T.stream_model_update(stream, linear, path, mark).awaitTermination()
    streamed = T.current_statistics(spark, path).select("device_id", F.col("n").alias("n_stream"), F.col("yy").alias("yy_stream"))
    both = streamed.join(linear.statistics(spark.read.schema(matrix.schema).parquet(rows_path)).select("device_id", "n", "yy"), "device_id")
    gap = F.greatest(F.abs(F.col("n") - F.col("n_stream")).cast("double"), F.round(F.abs(F.col("yy") - F.col("yy_stream")), 3))
    return both.select("device_id", "n_stream", (B.rounded(F.col("yy_stream") / CFG.horizon, 3) * CFG.horizon).alias("yy_stream"), gap.alias("gap"))


@query(f"""WITH {B.STEPS}, g AS (SELECT device_id, ts_hour, coalesce(last_value(grid_import IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(grid_import IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0) AS y FROM hourly)
SELECT s.device_id, s.origin, s.horizon, {r('g.y AS prediction')} FROM steps s JOIN g ON g.device_id = s.device_id AND g.ts_hour = s.origin - to_hours(CAST(23 - (s.horizon - 1) % 24 AS BIGINT))""")
def u2_window_predictor(spark, sf):
    """A user's function on windows: the value a day before, from the context."""
    df = B.hourly(spark, sf)
    w = X.context_and_future(X.gap_fill(df, "grid_import"), E.backtest_origins(df, CFG), "grid_import", 168, CFG, covariates=["hour_sin"])
    return T.window_predictor(w, lambda ctx, cov, future: [ctx[-24 + h % 24] for h in range(len(future))])


@query(f"""WITH {B.HOURLY} SELECT device_id, count(*) * 48 AS n, 0.0 AS largest_gap FROM hourly WHERE grid_import IS NOT NULL GROUP BY 1""")
def r3_saved_model(spark, sf):
    """A model written as tables and read again predicts what it did before."""
    matrix = B.stored(_matrix(spark, sf, pack=True))
    names = _inputs(matrix)
    linear = M.GroupedLinear("grid_import", names, ["device_id"])
    path, fitted = B.fresh_path(spark), B.stored(linear.fit(matrix))
    K.save_model({"coefficients": fitted}, path, {"features": names})
    tables, settings = K.load_model(spark, path)
    again = M.GroupedLinear("grid_import", settings["features"], ["device_id"])
    before = linear.told_packed(matrix, {"before": fitted}, matrix.columns)
    both = PK.unpacked(again.told_packed(before, {"after": tables["coefficients"]}, ["device_id", "before"]), "grid_import", ["before", "after"])
    return both.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("after") - F.col("before"))).alias("largest_gap"))


@query(f"{_FLAT} SELECT device_id, {r('sum(grid_export_kwh) AS export_kwh', 'sum(grid_import_kwh) AS import_kwh', 'sum(net_exchange_kwh) AS net_kwh')} FROM flat GROUP BY 1")
def a11_run_summary(spark, sf):
    verdicts = V.assess_sufficiency(B.hourly(spark, sf), CFG)
    cv = E.cross_validate(B.hourly(spark, sf), CFG, E.naive_backend(CFG))
    return A.run_summary(verdicts, R.flat_forecasts(_forecasts(spark, sf)), cv)["totals"]


@query("SELECT event_type, count(*) AS n, round(sum(value), 3) + 0.0 AS total FROM events GROUP BY 1")
def k2_write_reports(spark, sf):
    """A report written as CSV and read again."""
    path = B.fresh_path(spark)
    K.write_reports({"by_device": B.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), B.rounded(F.sum("value"), 3).alias("total"))}, path)
    return spark.read.option("header", True).schema("event_type string, n long, total double").csv(f"{path}/by_device")


@query(f"{_FLAT} SELECT device_id, origin AS forecast_origin, horizon, \"timestamp\", {r('grid_export_kwh', 'grid_import_kwh', 'net_exchange_kwh')} FROM flat")
def k1_write_forecasts(spark, sf):
    path = B.fresh_path(spark)
    K.write_forecasts(_forecasts(spark, sf), path)
    kind = "device_id string, forecast_origin timestamp, forecasts array<struct<horizon:int,timestamp:timestamp,grid_export_kwh:double,grid_import_kwh:double,net_exchange_kwh:double>>"
    return R.forecasts_to_frame(spark.read.schema(kind).json(path))


_SIDES = ("grid_export", "grid_import")
_BOUNDS = [f"{t}_{b}" for t in _SIDES for b in ("lower", "upper")]


@query(f"""{_POOLED}, sides AS (
  SELECT device_id, origin, horizon, ts_hour, {", ".join(f"coalesce(round(max(prediction) FILTER (target = '{t}'), 3), 0.0) AS {t}_kwh" for t in _SIDES)},
    {", ".join(f"max(greatest(0.0, prediction - shift)) FILTER (target = '{t}' AND shift > 0) AS {t}_lower, max(prediction + shift) FILTER (target = '{t}' AND shift > 0) AS {t}_upper" for t in _SIDES)}
  FROM ahead GROUP BY ALL)
SELECT device_id, origin AS forecast_origin, horizon, ts_hour AS "timestamp", {r('grid_export_kwh', 'grid_import_kwh', 'round(grid_export_kwh - grid_import_kwh, 3) AS net_exchange_kwh')},
  {", ".join(f"CASE WHEN {' AND '.join(f'{x} IS NOT NULL' for x in _BOUNDS)} THEN round({b}, 3) + 0.0 END AS {b}" for b in _BOUNDS)} FROM sides""")
def k1_forecast_bounds(spark, sf):
    """A pool's forecasts with bounds, written as nested JSON and read again."""
    path = B.fresh_path(spark)
    K.write_forecasts(_pooled(spark, sf)[2].withColumnsRenamed({"lower": "prediction_lower", "upper": "prediction_upper"}), path)
    numbers = ["grid_export_kwh", "grid_import_kwh", "net_exchange_kwh", *_BOUNDS]
    kind = f"device_id string, forecast_origin timestamp, forecasts array<struct<horizon:int,timestamp:timestamp,{','.join(f'{n}:double' for n in numbers)}>>"
    return R.forecasts_to_frame(spark.read.schema(kind).json(path)).select("device_id", "forecast_origin", "horizon", "timestamp", *numbers)


@query(_CV)
def k2_reports(spark, sf):
    """The library's reports of a naive run; that of the cross-validation is read again."""
    df = B.stored(B.hourly(spark, sf))
    naive = E.naive_backend(CFG)
    rows = B.stored(E.run_backtest(df, CFG, naive))
    path = B.fresh_path(spark)
    K.write_reports({"eligibility": V.assess_sufficiency(df, CFG), "cv": E.cross_validate(df, CFG, naive), "backtest": rows, "by_device": A.metrics(rows.drop("lower", "upper"), ["device_id", "target"])}, path)
    kinds = "device_id string, target string, cv_mae double, naive_mae double, n_origins long, skill double"
    return spark.read.option("header", True).schema(kinds).csv(f"{path}/cv").drop("skill")


# ------------------------------------------------------------------ the rest of the inventory

@query(f"WITH {B.METERS} SELECT device_id, ts, {r('consumption_kwh', 'production_kwh')} FROM meters")
def s2_load_meters(spark, sf):
    """Readings written as Parquet under other names, then loaded, normalised and validated."""
    path = B.fresh_path(spark, ".parquet")
    B.meters(spark, sf).withColumnsRenamed({"device_id": "Meter_ID", "ts": "Reading_Time", "consumption_kwh": "consumo", "production_kwh": "produzione"}).write.parquet(path)
    return S.load_meters(spark, path).select("device_id", "ts", "consumption_kwh", "production_kwh")


@query(f"WITH {B.WEATHER} SELECT datetime, {r('temperature_2m', 'shortwave_radiation')} FROM raw_weather")
def s3_load_weather(spark, sf):
    path = B.fresh_path(spark, ".parquet")
    B.raw_weather(spark, sf).write.parquet(path)
    return S.load_weather(spark, path).select("datetime", "temperature_2m", "shortwave_radiation")


@query(f"{_SITED} SELECT site_id, datetime, {r('clear')} FROM clear")
def x2_clearsky(spark, sf):
    placed = solar_position(B.sited_weather(spark, sf), "datetime", "latitude", "longitude")
    return placed.select("site_id", "datetime", clearsky_ghi(F.col("cos_zenith")).alias("clear"))


@query(f"WITH {B.STEPS} SELECT device_id, target, origin, count(*) AS n FROM joined WHERE n >= 40 GROUP BY ALL")
def j4_join_actuals(spark, sf):
    df = B.hourly(spark, sf)
    o = E.backtest_origins(df, CFG)
    fc = M.naive_forecast(df, o, "grid_export", CFG).unionByName(M.naive_forecast(df, o, "grid_import", CFG)).where("prediction is not null")
    return J.join_actuals(fc, J.long_targets(df, CFG.targets), 40).groupBy("device_id", "target", "origin").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS device_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j7_only_devices(spark, sf):
    urgent = B.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("device_id"))
    return V.only_devices(B.table(spark, sf, "customer").select(F.col("c_custkey").alias("device_id")), urgent)


@query(f"WITH {B.STEPS} SELECT device_id, origin, horizon, ts_hour FROM steps")
def j9_forecast_hours(spark, sf):
    return J.forecast_hours(E.backtest_origins(B.hourly(spark, sf), CFG))


@query(f"""{_RUNS} SELECT a.run_id, a.device_id, {r('b.total AS total')} FROM runs a LEFT JOIN (SELECT device_id, sum(price) AS total FROM runs WHERE price > 200000 GROUP BY 1) b USING (device_id)""")
def j10_left_metrics(spark, sf):
    runs, values = _runs(spark, sf)
    totals = values.join(runs, "run_id").where("value > 200000").groupBy("device_id").agg(F.sum("value").alias("total"))
    return runs.join(totals, "device_id", "left").select("run_id", "device_id", "total")


@query(f"{_CAND} SELECT candidate, device_id, target, origin, {r('mae')} FROM per")
def k3_write_benchmark(spark, sf):
    rows = _candidates(spark, sf)
    per = E.per_origin_mae(rows)
    path = B.fresh_path(spark)
    K.write_benchmark({"comparison": E.comparison(rows, E.common_cells(per)), "per_origin": per}, path)
    return spark.read.option("header", True).schema("candidate string, device_id string, target string, origin timestamp, mae double").csv(f"{path}/per_origin")


@query(f"WITH {B.METERS} SELECT device_id, count(*) AS n FROM meters GROUP BY 1")
def v1_validate(spark, sf):
    return V.validate(B.meters(spark, sf)).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {B.HOURLY} SELECT device_id, {r('avg(hour_sin) AS hour_sin', 'avg(CAST(day_of_week AS DOUBLE)) AS day_of_week')} FROM hourly GROUP BY 1""")
def f6_resolve_features(spark, sf):
    """The covariates that a table without weather leaves: the calendar's columns, averaged by device."""
    df = B.hourly(spark, sf)
    names = V.resolve_covariates("grid_import", CFG, columns=df.columns)
    return df.groupBy("device_id").agg(*(F.avg(c).alias(c) for c in names)).select("device_id", "hour_sin", "day_of_week")

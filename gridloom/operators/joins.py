"""Joins of time series: lags, nearest times, bands and forecast origins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import hours


def by_device(df: DataFrame) -> DataFrame:
    """Dealt by device into one part more than the session shuffles to.

    The windows of a device's hours cost much for few bytes, and adaptive execution, which goes
    by bytes, would leave them to a task or two. Of the session's own number the parts of a shuffle below, such
    as that of the distinct devices, would count as dealt already, and be merged by their bytes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, "device_id")


def lag_lookup(df: DataFrame, key: str, ts: str, value: str, lags: Sequence[int], prefix: str | None = None) -> DataFrame:
    """Adds <prefix>_<k>h, the value k hours earlier by time, not by row; null where that hour is absent.

    Each row is sent ahead by every lag and the rows that meet at an hour are
    pivoted by one aggregation, so all lags cost one shuffle by (key, hour).
    """
    prefix = prefix or f"{value}_lag"
    ahead = df.select(key, F.explode(F.array(*[F.lit(k) for k in lags])).alias("_k"), F.col(ts).alias("_t"), F.col(value).alias("_v"))
    ahead = ahead.select(key, (F.col("_t") + hours(F.col("_k"))).alias(ts), "_k", "_v", "_t")
    found = ahead.groupBy(key, ts).agg(*(F.max_by(F.when(F.col("_k") == k, F.col("_v")), F.when(F.col("_k") == k, F.col("_t"))).alias(f"{prefix}_{k}h") for k in lags))
    return df.join(found, [key, ts], "left")


def nearest_join(left: DataFrame, right: DataFrame, ts_left: str, ts_right: str, by: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds the columns of the row of ``right`` nearest in time; of two as near, the later one.

    The nearest row is looked up once for each distinct time (and ``by``), by two
    windows whose frames only grow, and joined back by equality: without ``by``
    one timeline of distinct times is ordered, a few thousand hours a year
    however many rows the fleet has.
    """
    columns = [c for c in (columns or right.columns) if c not in (ts_right, by)]
    row = F.struct(F.col(ts_right).alias("_at"), *columns)
    keys = [by] if by else []
    there = right.select(*keys, F.col(ts_right).alias("_t"), F.lit(0).alias("_side"), row.alias("_r")).where("_t is not null").dropDuplicates([*keys, "_t"])
    moments = left.select(*keys, F.col(ts_left).alias("_t"), F.lit(1).alias("_side")).where("_t is not null").distinct()
    both = moments.unionByName(there, allowMissingColumns=True)
    part = Window.partitionBy(*(keys or [F.lit(0)]))
    before, after = (F.last("_r", True).over(part.orderBy(o, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)) for o in (F.col("_t"), F.desc("_t")))
    both = both.withColumns({"_b": before, "_a": after}).where("_side = 1")
    gap = lambda c: F.abs(F.unix_micros(F.col("_t")) - F.unix_micros(F.col(f"{c}._at")))
    pick = F.when(F.col("_b").isNull() | (gap("_a") <= gap("_b")), F.col("_a")).otherwise(F.col("_b"))
    found = both.select(*keys, F.col("_t").alias(ts_left), F.coalesce(pick, F.col("_b")).alias("_p"))
    return left.join(found, [*keys, ts_left], "left").select(*left.columns, *(F.col(f"_p.{c}").alias(c) for c in columns))


def next_time(df: DataFrame, cuts: DataFrame, time: str, cut: str, name: str, times: DataFrame | None = None, few: bool = False) -> DataFrame:
    """Rows with ``name``, the first ``cut`` at or after their ``time``; rows after the last one go.

    Like nearest_join it works on distinct times, so nothing is collected. ``times``: a table that has all
    times of ``df``, where working out ``df`` twice would be dear. With ``few`` (hours of the calendar, say) the
    distinct times are broadcast, as their number isn't known before ``df`` would be dealt by time.
    """
    moments = (df if times is None else times).select(F.col(time).alias("_t"), F.lit(1).alias("_side")).distinct()
    both = moments.union(cuts.select(F.col(cut).alias("_t"), F.lit(0)).distinct())
    reversed_ = Window.partitionBy(F.lit(0)).orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn(name, F.last(F.when(F.col("_side") == 0, F.col("_t")), True).over(reversed_)).where(f"_side = 1 and `{name}` is not null")
    found = both.select(F.col("_t").alias(time), name)
    return df.join(F.broadcast(found) if few else found, time)


def join_actuals(forecasts: DataFrame, actuals: DataFrame, min_rows: int = 12, cell: Sequence[str] = ("device_id", "target", "origin")) -> DataFrame:
    """Forecasts with the actual of their hour; only of cells in which at least min_rows hours have one."""
    joined = forecasts.join(actuals.where("actual is not null"), ["device_id", "target", "ts_hour"])
    counted = joined.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*cell)))
    return counted.where(F.col("_n") >= min_rows).drop("_n")


def long_targets(df: DataFrame, targets: Sequence[str], value: str = "actual", keep: Sequence[str] = ()) -> DataFrame:
    """One row a device, target and hour."""
    pairs = ", ".join(f"'{t}', `{t}`" for t in targets)
    return df.selectExpr("device_id", "ts_hour", *keep, f"stack({len(targets)}, {pairs}) AS (target, {value})")


def band_join(df: DataFrame, bounds: DataFrame, time: str = "ts_hour") -> DataFrame:
    """Rows between valid_start and valid_end of their device, both included; an equi-join with a range on top."""
    return df.join(bounds.select("device_id", "valid_start", "valid_end"), "device_id").where(F.col(time).between(F.col("valid_start"), F.col("valid_end")))


def in_buckets(df: DataFrame, origins: DataFrame, keys: Sequence[str], at: Column, first: Column, last: Column, width: int) -> DataFrame:
    """``df`` joined with the origins whose range of buckets from ``first`` to ``last`` holds a row's own.

    ``at`` is a column of df, ``first`` and ``last`` are columns of origins, all longs; a
    bucket is ``width`` of them. An equi-join: a row meets the origins near it and no others,
    so what comes out doesn't grow with the years before an origin. Edges are the caller's to cut.
    """
    bucket = lambda c: F.floor(c / width).cast("long")
    there = origins.withColumn("_bucket", F.explode(F.sequence(bucket(first), bucket(last))))
    return df.withColumn("_bucket", bucket(at)).join(there, [*keys, "_bucket"]).drop("_bucket")


def recent_rows(df: DataFrame, origins: DataFrame, n: int, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Each origin's last ``n`` rows at or before it, with _back, how many rows from the last (0).

    Rows are numbered once; an origin takes the number that it stands at, and meets
    the rows in the one or two buckets of ``n`` numbers that reach back from it.
    """
    keys = list(keys)
    own = Window.partitionBy(*keys).orderBy("ts_hour")
    numbered = df.withColumn("_i", F.row_number().over(own).cast("long"))
    moments = origins.select(*keys, "origin").distinct()
    both = numbered.select(*keys, F.col("ts_hour").alias("origin"), "_i", F.lit(0).alias("_side")).unionByName(moments.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    upto = F.max("_i").over(Window.partitionBy(*keys).orderBy("origin", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = both.withColumn("_last", upto).where("_side = 1 and _last is not null").select(*keys, "origin", "_last")
    joined = in_buckets(numbered, at, keys, F.col("_i"), F.greatest(F.col("_last") - (n - 1), F.lit(0)), F.col("_last"), n)
    return joined.withColumn("_back", F.col("_last") - F.col("_i")).where(F.col("_back").between(0, n - 1)).drop("_i", "_last")


def origin_join(df: DataFrame, origins: DataFrame, side: str = "horizon", horizon: int = 48, back_hours: int | None = None) -> DataFrame:
    """Rows of each origin: its history (up to the origin) or the hours of its horizon, with their number.

    The horizon's hours are listed from the origins and joined by equality. Of the history,
    the last ``back_hours`` hours are joined by day; without a bound it is all that came
    before, which grows with the years.
    """
    keys = [c for c in origins.columns if c != "origin"]
    if side == "history":
        if back_hours is None:
            return df.join(origins, keys).where("ts_hour <= origin")
        end = F.unix_timestamp("origin")
        near = in_buckets(df, origins, keys, F.unix_timestamp("ts_hour"), end - back_hours * 3600, end, 86_400)
        return near.where((F.col("ts_hour") <= F.col("origin")) & (F.col("ts_hour") > F.col("origin") - hours(back_hours)))
    steps = forecast_hours(origins, horizon)
    return steps.join(df, [*keys, "ts_hour"])


def forecast_hours(origins: DataFrame, horizon: int = 48) -> DataFrame:
    """Each origin with the hours after it: horizon 1, 2, ... and ts_hour."""
    steps = origins.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("ts_hour", F.col("origin") + hours(F.col("horizon")))

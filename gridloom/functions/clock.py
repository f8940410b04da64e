"""Time arithmetic on columns: hours, local calendars and daylight-saving changes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def epoch_hours(ts: Column) -> Column:
    return (F.unix_timestamp(ts) / 3600).cast("long")


def floor_minutes(ts: Column, minutes: int) -> Column:
    size = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / size) * size)


def has_zone(text: Column) -> Column:
    """Does a time written as text end in a zone?"""
    return text.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$")


def localize_utc(local: Column, tz: str) -> Column:
    """The UTC instant of a local wall time: null where it is ambiguous, the hour's start where the clock skips it."""
    at = F.to_utc_timestamp(local, tz)
    later = F.from_utc_timestamp(at + F.expr("INTERVAL 1 HOUR"), tz)
    back = F.from_utc_timestamp(at, tz)
    return F.when(later == local, F.lit(None).cast("timestamp")).when(back != local, F.date_trunc("hour", at)).otherwise(at)


def calendar(ts: Column, tz: str) -> dict[str, Column]:
    """hour_local, day_of_week (Monday 0), month, is_weekend, hour_sin, hour_cos of a UTC instant."""
    local = F.from_utc_timestamp(ts, tz)
    hour, day = F.hour(local), F.weekday(local)
    angle = hour.cast("double") * (2 * math.pi / 24)
    return {
        "hour_local": hour, "day_of_week": day, "month": F.month(local), "is_weekend": (day >= 5).cast("int"),
        "hour_sin": F.sin(angle), "hour_cos": F.cos(angle),
    }


def at_least(x: Column, low: float) -> Column:
    """max(x, low), null for null (greatest() would skip the null)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(float(low))))


def not_nan(x: Column) -> Column:
    return F.nanvl(x, F.lit(None).cast("double"))

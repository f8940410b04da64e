"""Sun position and clear-sky irradiance as column expressions.

Spencer's Fourier series for declination and the equation of time, as the NOAA
solar calculator publishes them, and Haurwitz's clear-sky model.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (harmonic, cosine, sine) coefficients of the published series.
DECLINATION = ((0, 0.006918, 0.0), (1, -0.399912, 0.070257), (2, -0.006758, 0.000907), (3, -0.002697, 0.00148))
TIME_EQUATION = ((0, 0.000075, 0.0), (1, 0.001868, -0.032077), (2, -0.014615, -0.040849))
TIME_SCALE = 229.18
HAURWITZ_SCALE, HAURWITZ_DAMPING = 1098.0, 0.059


def _series(terms: tuple[tuple[int, float, float], ...], angle: Column) -> Column:
    total = F.lit(0.0)
    for k, a, b in terms:
        total = total + F.lit(a) * F.cos(angle * k) + F.lit(b) * F.sin(angle * k)
    return total


def cosine_of_zenith(ts: Column, lat: Column, lon: Column) -> Column:
    """In [-1, 1]; negative at night."""
    minutes = F.hour(ts) * 60.0 + F.minute(ts)
    year = (F.dayofyear(ts) - 1 + (minutes / 60.0 - 12) / 24.0) * (2 * math.pi / 365.0)
    declination = _series(DECLINATION, year)
    solar_minutes = minutes + _series(TIME_EQUATION, year) * TIME_SCALE + lon * 4.0
    turn = F.radians(solar_minutes / 4.0 - 180.0)
    phi = F.radians(lat)
    cosine = F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(turn)
    return F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))


def solar_position(df: DataFrame, ts: str, lat: float | str, lon: float | str) -> DataFrame:
    """Adds solar_elevation (degrees) and cos_zenith (0 at night)."""
    place = [F.col(x) if isinstance(x, str) else F.lit(float(x)) for x in (lat, lon)]
    cosine = cosine_of_zenith(F.col(ts), *place)
    return df.withColumns({"solar_elevation": F.degrees(F.asin(cosine)), "cos_zenith": F.greatest(cosine, F.lit(0.0))})


def clearsky_ghi(cos_zenith: Column) -> Column:
    c = F.least(cos_zenith, F.lit(1.0))
    return F.when(c > 0, HAURWITZ_SCALE * c * F.exp(F.lit(-HAURWITZ_DAMPING) / c)).otherwise(F.lit(0.0))

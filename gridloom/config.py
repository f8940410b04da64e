"""Settings of all operators, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

WEATHER_COLUMNS = (
    "global_tilted_irradiance", "shortwave_radiation", "cloud_cover", "temperature_2m", "clearsky_index", "effective_solar_pv",
    "heating_degree", "cooling_degree", "is_daylight", "solar_elevation", "cloud_cover_diff", "pv_temp_factor",
)
CALENDAR = ("hour_sin", "hour_cos", "day_of_week", "month", "is_weekend")
LAGS = ("same_hour_1d", "same_hour_2d", "same_hour_3d", "same_hour_7d", "same_hour_14d", "mean_same_hour_7d", "diff_1d", "diff_7d", "roll_24h_mean", "roll_24h_std")

#: The weather columns that each target's model uses.
WEATHER_BY_TARGET = MappingProxyType({
    "grid_export": (
        "global_tilted_irradiance", "shortwave_radiation", "cloud_cover", "clearsky_index", "effective_solar_pv", "solar_elevation",
        "cloud_cover_diff", "pv_temp_factor", "ghi_ramp", "temperature_2m", "is_daylight",
    ),
    "grid_import_pv": ("temperature_2m", "heating_degree", "is_daylight", "effective_solar_pv", "clearsky_index", "cloud_cover", "solar_elevation"),
    "grid_import_no_pv": ("temperature_2m", "heating_degree", "is_daylight"),
})


@dataclass(frozen=True)
class Config:
    local_tz: str = "Europe/Rome"
    targets: tuple[str, ...] = ("grid_export", "grid_import")
    start_date: str | None = None
    noise_floor_kwh: float = 0.020
    max_gap_hours: int = 1
    outlier_window_hours: int = 168
    outlier_min_periods: int = 24
    outlier_zscore: float = 3.0
    min_span_days: float | None = 42.0
    min_coverage: float = 0.40
    export_min_mean_kwh: float = 0.01
    import_min_mean_kwh: float = 0.01
    cv_folds: int = 4
    cv_test_days: int = 7
    #: name -> first and last horizon
    bands: tuple[tuple[str, int, int], ...] = (("short", 1, 8), ("medium", 9, 24), ("long", 25, 48))
    horizon: int = 48
    quantile_low: float = 0.25
    quantile_high: float = 0.75
    cqr_coverage: float = 0.50
    cqr_split: float = 0.80
    cqr_min_rows: int = 30
    validation_split: float = 0.85
    backtest_origins: int = 21
    warmup_days: int = 14
    naive_lag_hours: int = 168
    min_matched_hours: int = 12
    drift_threshold: float = 0.15
    retention_days: int = 7
    lookback_days: int = 1
    heating_base_c: float = 18.0
    cooling_base_c: float = 24.0
    pv_temp_coeff: float = 0.004
    pv_temp_ref_c: float = 25.0
    ridge: float = 1e-3
    calendar: tuple[str, ...] = CALENDAR
    lags: tuple[str, ...] = LAGS
    weather_by_target: MappingProxyType = field(default_factory=lambda: WEATHER_BY_TARGET)

    @property
    def span_needed(self) -> float:
        return self.cv_folds * self.cv_test_days + 14 if self.min_span_days is None else self.min_span_days

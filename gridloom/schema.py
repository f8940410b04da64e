"""Table contracts: which column plays which role, and what a valid table looks like."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .config import Config


class SchemaError(ValueError):
    """A table breaks its contract; the message names the column."""


@dataclass(frozen=True)
class Roles:
    """Which columns of another domain hold the entity, the hour and the targets.

    Operators name device_id and ts_hour; a table of another domain is renamed on its way
    in (``standard``) and on its way out (``own``), which costs no job, and its targets
    are the settings' targets (``settings``).
    """

    entity: str = "device_id"
    time: str = "ts_hour"
    targets: tuple[str, ...] = ("grid_export", "grid_import")

    @property
    def _names(self) -> dict[str, str]:
        return {self.entity: "device_id", self.time: "ts_hour"}

    def standard(self, df: DataFrame) -> DataFrame:
        """Raises SchemaError for a column that is missing, a target that isn't a number, or a name that is taken."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        for name in (self.entity, self.time, *self.targets):
            if name not in kinds:
                raise SchemaError(f"{name}: no such column")
        for name in self.targets:
            if not isinstance(kinds[name], T.NumericType):
                raise SchemaError(f"{name}: not a number")
        for old, new in self._names.items():
            if old != new and new in kinds and new not in self._names:
                raise SchemaError(f"{new}: the name is needed for {old}")
        return df.withColumnsRenamed(self._names)

    def own(self, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({new: old for old, new in self._names.items() if new in df.columns})

    def settings(self, cfg: Config) -> Config:
        return replace(cfg, targets=self.targets)


METER_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("consumption_kwh", T.DoubleType()), T.StructField("production_kwh", T.DoubleType()),
])


def utc(spark: SparkSession) -> SparkSession:
    """All instants are handled in UTC; local time is derived where a feature asks for it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark

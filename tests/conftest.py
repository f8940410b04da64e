from __future__ import annotations

import datetime as dt
import os
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("gridloom-tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


def quarter_hours(start: str, days: int):
    at = dt.datetime.fromisoformat(start).replace(tzinfo=dt.timezone.utc)
    return [at + dt.timedelta(minutes=15 * i) for i in range(days * 96)]


@pytest.fixture(scope="session")
def raw_meters(spark):
    """Two devices, one with production, 30 days of quarter hours."""
    rnd = random.Random(7)
    rows = []
    for device, pv in (("dev-A", True), ("dev-B", False)):
        for ts in quarter_hours("2025-02-01", 30):
            sun = max(0.0, 1 - abs(ts.hour - 12) / 6)
            rows.append((device, ts, round(0.1 + 0.05 * rnd.random(), 4), round(0.5 * sun * rnd.random(), 4) if pv else 0.0))
    return spark.createDataFrame(rows, "device_id string, ts timestamp, consumption_kwh double, production_kwh double").cache()

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("roadlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roadlens-test-ckpt-"))
    yield s


def event_row(**over):
    """One typed raw event with safe defaults; override any field."""
    base = dict(
        event_id="E1",
        driver_id="D1",
        vehicle_id="V1",
        driver_profile="average",
        event_time="2026-01-01T00:00:00.000Z",
        speed_kmh=50.0,
        speed_limit_kmh=50.0,
        acceleration_ms2=0.5,
        braking_ms2=-1.0,
        cornering_g=0.1,
        road_type="urban",
        weather="clear",
        is_night=False,
        distance_delta_km=0.02,
        phone_usage=False,
    )
    base.update(over)
    return base


@pytest.fixture()
def make_events(spark):
    from roadlens.operators.events import normalise_event_time
    from roadlens.schemas import EVENT_SCHEMA

    def make(rows):
        nullable = EVENT_SCHEMA.__class__([f.__class__(f.name, f.dataType, True) for f in EVENT_SCHEMA.fields])
        df = spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA.fields) for r in rows], nullable)
        return normalise_event_time(df)

    return make

"""Daily zone aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.sensors import FAULTY, SENSORS, Sensor

DAY_KEYS = ("date_partition", "zone")


def _aggregate(name: str, call: str, field: str) -> Column:
    return F.expr(f"sum({FAULTY})" if call == "faults" else f"{call}({field})").alias(name)


def daily(readings: DataFrame, sensor: Sensor) -> DataFrame:
    """One row per day and zone with the sensor's own measures."""
    measures = [_aggregate(*spec) for spec in sensor.daily]
    return readings.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("nb_mesures"), *measures)


def daily_by_name(readings: DataFrame, sensor_name: str) -> DataFrame | None:
    """Daily aggregates by sensor name; an unknown sensor gives nothing."""
    sensor = SENSORS.get(sensor_name)
    return daily(readings, sensor) if sensor else None

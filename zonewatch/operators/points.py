"""Long time-series points: one row per measurement, tags, field and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from zonewatch.functions import times, values
from zonewatch.sensors import SERIES, Sensor, by_sensor

POINT_COLUMNS = (*SERIES, "value", "time")
_FLAGS = {"faulty_count": "faulty", "alert_flag": "true"}


def _value(readings: DataFrame, field: str, source: str) -> Column:
    if field in _FLAGS:
        return values.flag(F.col(source), _FLAGS[field])
    if isinstance(readings.schema[source].dataType, NumericType):
        return F.col(source).cast("double")
    return values.number(F.col(source))


def reading_points(
    readings: DataFrame,
    sensors: tuple[Sensor, ...],
    fields: tuple[str, ...] | None = None,
    arrival: Column | None = None,
) -> DataFrame:
    """Points of the sensors' readings, optionally of some fields only.

    Fields that are missing or no number give no point; the two flags always give one.
    A missing or unreadable time becomes the arrival time. Each sensor's fields are laid into
    as many value slots as the widest sensor has, and only those slots are unpivoted.
    """
    arrival = F.current_timestamp() if arrival is None else arrival
    known = "event_time" in readings.columns
    time = F.coalesce(F.col("event_time"), arrival) if known else times.time_or(F.col("timestamp"), arrival)
    chosen = {
        s: [(f, src) for f, src in s.point_fields.items() if fields is None or f in fields] for s in sensors
    }
    used = tuple(s for s in sensors if chosen[s])
    slots = [f"v{i}" for i in range(max(len(chosen[s]) for s in used))]

    def value(sensor: Sensor, place: int) -> Column:
        wanted = chosen[sensor]
        return _value(readings, *wanted[place]) if place < len(wanted) else F.lit(None).cast("double")

    tagged = readings.filter(F.col("sensor").isin([s.name for s in used])).select(
        F.col("sensor").alias("measurement"),
        values.tag(F.col("zone")).alias("zone"),
        values.tag(F.col("device_id")).alias("device_id"),
        time.alias("time"),
        *[by_sensor(lambda s, i=i: value(s, i), used).alias(slot) for i, slot in enumerate(slots)],
    )
    names = " ".join(
        f"WHEN measurement = '{s.name}' AND slot = 'v{i}' THEN '{field}'"
        for s in used
        for i, (field, _) in enumerate(chosen[s])
    )
    long = tagged.unpivot([*SERIES[:3], "time"], slots, "slot", "value")
    # The comparison also drops nulls.
    finite = long.filter(F.abs("value") < float("inf"))
    return finite.selectExpr(*SERIES[:3], f"CASE {names} END AS field", "value", "time")


def alert_points(rows: DataFrame) -> DataFrame:
    """Alerts and trends as points at their window start; rows without a value give none."""
    return rows.filter(F.col("valeur_detectee").isNotNull()).select(
        F.col("window_start").alias("time"),
        "zone",
        F.col("alert_level").alias("niveau"),
        F.col("type_capteur").alias("type"),
        F.col("valeur_detectee").cast("double").alias("valeur"),
        F.lit("window").alias("source"),
    )


def arrival_points(records: DataFrame, arrival: Column) -> DataFrame:
    """Alert records as points at the time they arrived; a missing value counts as 0."""
    return records.select(
        arrival.alias("time"),
        values.tag(F.col("zone")).alias("zone"),
        values.tag(F.col("alert_level")).alias("niveau"),
        values.tag(F.col("type_capteur")).alias("type"),
        F.coalesce(F.col("valeur_detectee").cast("double"), F.lit(0.0)).alias("valeur"),
        F.lit("arrival").alias("source"),
    )

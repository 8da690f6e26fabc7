"""Sensor readings derived by projection from the driver's ``events`` table.

Each event type plays one sensor kind. The dense clock squeezes the month sixty-fold,
so that sliding windows of minutes hold several readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.functions import times
from zonewatch.sensors import Sensor, case_by_sensor, chosen, quoted, wide_schema
from zonewatch.session import prepare
from zonewatch.settings import ZONES

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
EVENT_TYPES = {"pollution": "view", "traffic": "click", "eclairage": "error", "dechets": "purchase"}
EPOCH = 1704067200000000
SQUEEZE = 60


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; it may be one file or a folder of part files."""
    return spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def zone_of(user: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(z) for z in ZONES]), (F.pmod(user, F.lit(len(ZONES))) + 1).cast("int"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def dense(ts: Column) -> Column:
    """Event time on the dense clock."""
    since = F.call_function("div", micros(ts) - F.lit(EPOCH), F.lit(SQUEEZE))
    return F.timestamp_micros(F.lit(EPOCH) + since)


def undense(time: Column) -> Column:
    """Earliest original time whose dense time is not before ``time``."""
    return F.timestamp_micros(F.lit(EPOCH) + (F.unix_micros(time) - F.lit(EPOCH)) * SQUEEZE).cast("timestamp_ntz")


K = "try_cast(get_json_object(props, '$.k') AS int)"
# The sensors' fields as SQL over (event_id, k, value). Numbers are rounded by floor, so that
# halves go the same way in every engine.
FIELDS = {
    "pollution": {"co2_ppm": "350 + 5 * value", "pm25": "0.8D * k", "air_quality_index": "5 * k"},
    "traffic": {
        "vehicles_per_min": "k",
        "avg_speed_kmh": "least(value, 120D)",
        "congestion": "CASE WHEN k > 100 THEN 'critical' WHEN k > 70 THEN 'high' WHEN k > 40 THEN 'medium' ELSE 'low' END",
    },
    "eclairage": {
        "luminosity_lux": "k",
        "status": "CASE WHEN event_id % 20 = 0 THEN 'faulty' ELSE 'working' END",
        "power_kw": "floor(least(value, 120D) / 2 + 0.5D) / 100",
    },
    "dechets": {
        "fill_percent": "k + 0.5D",
        "weight_kg": "floor(12D * (k + 0.5D) + 0.5D) / 10",
        "alert": "CASE WHEN k + 0.5D > 90 THEN 'true' ELSE 'false' END",
    },
}


def as_readings(source: DataFrame, sensors: tuple[Sensor, ...], clock: str = "dense") -> DataFrame:
    """Readings of the sensors in the wide form, one pass over the events.

    ``clock``: ``dense`` for windows, ``calendar`` for daily work. With one sensor only its own
    fields are there; with several, a field is null on the rows of other sensors.
    """
    kinds = {EVENT_TYPES[s.name]: s.name for s in sensors}
    names = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{n}'" for k, n in kinds.items()) + " END"
    time = dense(F.col("ts")) if clock == "dense" else F.col("ts").cast("timestamp")
    rows = source.filter(F.col("event_type").isin(list(kinds))).select(
        "event_id",
        "value",
        F.expr(K).alias("k"),
        F.expr(names).alias("sensor"),
        zone_of(F.col("user_id")).alias("zone"),
        time.alias("event_time"),
    )
    prefix = case_by_sensor(lambda s: f"'{s.device_prefix}'", sensors)
    base = {
        "timestamp": f"date_format(event_time, {quoted(times.MESSAGE_FORMAT)})",
        "device_id": f"concat({prefix}, '_', zone)",
        "zone": "zone",
        "type": "sensor",
    }
    schema = sensors[0].schema if len(sensors) == 1 else wide_schema()
    fields = {}
    for sensor in sensors:
        for name, text in FIELDS[sensor.name].items():
            fields[name] = text if len(sensors) == 1 else f"CASE WHEN sensor = '{sensor.name}' THEN {text} END"
    typed = [
        f"cast({(base | fields)[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema
        if f.name in base or f.name in fields
    ]
    return rows.selectExpr("event_id", "sensor", "event_time", *typed)


def readings(spark: SparkSession, sf_dir: str, *names: str, clock: str = "dense") -> DataFrame:
    return as_readings(events(spark, sf_dir), chosen(names), clock)


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Readings as the processed table holds them: with day and hour."""
    rows = readings(spark, sf_dir, name, clock="calendar")
    day, hour = times.day_of(F.col("event_time")), times.hour_of(F.col("event_time"))
    return rows.withColumn("date_partition", day).withColumn("heure", hour)


def recent(spark: SparkSession, sf_dir: str, back: str, *names: str) -> tuple[DataFrame, Column]:
    """(readings since ``back`` before the newest event, that newest time on the dense clock).

    Both are subqueries of one value.
    """
    source = events(spark, sf_dir)
    now = source.agg(dense(F.max("ts")).alias("now")).scalar()
    floor = source.agg(undense(dense(F.max("ts")) - F.expr(f"INTERVAL {back}")).alias("floor")).scalar()
    return as_readings(source.filter(F.col("ts") >= floor), chosen(names)), now


def with_gaps(rows: DataFrame, sensor: Sensor) -> DataFrame:
    """Readings with nulls and copies: every 17th row lacks its first required metric, every
    10th has an exact copy, and of every 10th with a remainder of 5 a poorer copy exists."""
    first = sensor.required[0]
    number = F.col("event_id")
    whole, poorer = F.lit(0), F.lit(1)
    copies = (
        F.when(number % 10 == 0, F.array(whole, whole))
        .when(number % 10 == 5, F.array(whole, poorer))
        .otherwise(F.array(whole))
    )
    kept = (number % 17 != 0) & (F.col("copy") == whole)
    copied = rows.withColumn("copy", F.explode(copies))
    return copied.withColumn(first, F.when(kept, F.col(first))).drop("copy")


def messages(rows: DataFrame, sensor: Sensor) -> DataFrame:
    """Readings of one sensor as JSON bytes in ``value``."""
    body = F.to_json(F.struct(*sensor.schema.fieldNames())).cast("binary")
    return rows.select("event_id", "sensor", body.alias("value"))

"""Messages to typed readings, and the reasons for which a message is set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField

from zonewatch.functions import times
from zonewatch.sensors import Sensor, wide_schema

CORRUPT = "_corrupt_record"


def decode(messages: DataFrame, sensor: Sensor, strict_time: bool = False) -> DataFrame:
    """Typed readings of one sensor from a binary or text ``value``; bad JSON gives null fields.

    The parsed struct leaves through a generator. Later filters on its fields stop there; pushed
    below the parse they would parse every message once more.
    """
    body = F.from_json(F.col("value").cast("string"), sensor.schema)
    return (
        messages.select(F.inline(F.array(body)))
        .withColumn("sensor", F.lit(sensor.name))
        .withColumn("event_time", times.event_time(F.col("timestamp"), strict_time))
    )


def decode_any(
    messages: DataFrame, sensor: Column, text: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Readings of mixed sensors in one pass over the wide schema. ``sensor`` names each row's kind;
    rows without a kind and payloads that are not objects are left out (``unread`` has them). With
    ``text`` all fields stay text, and a field of another type does not become null."""
    rows = _opened(messages, sensor, text, keep).filter("sensor IS NOT NULL AND readable")
    fields = [f"d.{f}" for f in wide_schema().fieldNames()]
    found = rows.select(*keep, "sensor", *fields)
    return found if text else found.withColumn("event_time", times.event_time(F.col("timestamp")))


def _opened(messages: DataFrame, sensor: Column, text: bool, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``sensor``, ``value``, the parsed struct ``d``, and whether the message is an object."""
    named = messages.select(*keep, sensor.alias("sensor"), F.col("value").cast("string").alias("value"))
    if text:
        schema = wide_schema(text=True).add(CORRUPT, "string")
        body = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
        readable = f"d IS NOT NULL AND d.{CORRUPT} IS NULL"
    else:
        # A struct with a field is an object; one without may be, and is looked at again.
        body = F.from_json("value", wide_schema())
        some = " OR ".join(f"d.{f} IS NOT NULL" for f in wide_schema().fieldNames())
        readable = f"{some} OR json_object_keys(value) IS NOT NULL"
    return named.select("*", F.explode(F.array(body)).alias("d")).withColumn("readable", F.expr(readable))


def unread(messages: DataFrame, sensor: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages that give no stored reading, with their raw text and the reason: no object, a topic that
    nobody reads, or a missing or unreadable key."""
    rows = _opened(messages, sensor, False, keep).select("*", "d.timestamp", "d.device_id")
    reason = (
        F.when(F.col("sensor").isNull(), "unknown_sensor")
        .when(~F.col("readable"), "unreadable")
        .when(F.col("device_id").isNull(), "no_device")
        .when(F.col("timestamp").isNull(), "no_time")
        .when(times.event_time(F.col("timestamp")).isNull(), "bad_time")
    )
    return rows.select(*keep, "sensor", "value", reason.alias("reject_reason")).filter("reject_reason IS NOT NULL")


def _number(field: StructField) -> str:
    """SQL text of a number field from its ``<name>_n`` double."""
    n = f"{field.name}_n"
    whole = f"if({n} = floor({n}) AND abs({n}) < 2147483648D, cast({n} AS int), NULL)"
    return whole if field.dataType.simpleString() == "int" else n


def decode_lines(lines: DataFrame, sensor: Sensor) -> DataFrame:
    """Readings of one sensor from raw text lines, for the batch load. Numbers are taken from any form
    that holds their value (``12.0`` and ``"12"`` are 12); ``bad_number`` names the first field that is
    filled but no number, and ``value`` keeps the line. Lines that are no object have null fields."""
    schema = sensor.text_schema.add(CORRUPT, "string")
    body = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select("value", F.explode(F.array(body)).alias("d"))
    texts = {f.name: f"if(d.{CORRUPT} IS NULL, d.{f.name}, NULL)" for f in sensor.schema}
    numbers = {f.name: _number(f) for f in sensor.fields if isinstance(f.dataType, NumericType)}
    rows = rows.selectExpr(
        "value",
        *[f"{text} AS {name}" for name, text in texts.items()],
        *[f"try_cast({texts[name]} AS double) AS {name}_n" for name in numbers],
    )
    bad = ", ".join(f"if({name} IS NOT NULL AND {n} IS NULL, '{name}', NULL)" for name, n in numbers.items())
    typed = [f"{numbers.get(name, name)} AS {name}" for name in texts]
    return rows.selectExpr(*typed, "value", f"coalesce({bad}) AS bad_number")


def with_calendar(readings: DataFrame) -> DataFrame:
    """Event time plus the partition day and the hour of day."""
    time = F.col("event_time")
    return (
        readings.withColumn("event_time", times.event_time(F.col("timestamp")))
        .withColumn("date_partition", times.day_of(time))
        .withColumn("heure", times.hour_of(time))
    )


def reject_reason(numbers: bool = False) -> Column:
    """Why a row cannot be stored, null for a good row. Needs ``event_time``, with ``numbers`` also ``bad_number``."""
    nothing = F.col("timestamp").isNull() & F.col("device_id").isNull() & F.col("zone").isNull()
    reason = (
        F.when(nothing, "unreadable")
        .when(F.col("device_id").isNull(), "no_device")
        .when(F.col("timestamp").isNull(), "no_time")
        .when(F.col("event_time").isNull(), "bad_time")
    )
    return reason.when(F.col("bad_number").isNotNull(), "bad_number") if numbers else reason

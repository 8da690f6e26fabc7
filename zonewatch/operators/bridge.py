"""Routing of device events to sensor topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch import settings
from zonewatch.functions import routing


def resolved(events: DataFrame) -> DataFrame:
    """Adds ``device`` and ``sensor`` to events with ``value`` and ``hub_device_id``."""
    payload_id = F.get_json_object(F.col("value").cast("string"), "$.device_id")
    device = routing.device_id(F.col("hub_device_id"), payload_id)
    return events.withColumn("device", device).withColumn("sensor", routing.sensor_of_device(F.col("device")))


def split_routes(events: DataFrame, prefix: str = settings.TOPIC_PREFIX) -> tuple[DataFrame, DataFrame]:
    """(messages with their topic, dead letters of devices no topic takes)."""
    known = resolved(events)
    taken = known.filter(F.col("sensor").isNotNull())
    topic = F.concat(F.lit(f"{prefix}-"), F.col("sensor"))
    letters = known.filter(F.col("sensor").isNull()).select("value", "device")
    return taken.select(topic.alias("topic"), "value", "sensor", "device"), letters

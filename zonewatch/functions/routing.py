"""Which sensor stream a device belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewatch import settings
from zonewatch.functions.values import UNKNOWN


def device_id(hub_id: Column, payload_id: Column) -> Column:
    """The hub's own device id, else the one in the message, else ``unknown``."""
    return F.coalesce(F.nullif(hub_id, F.lit(UNKNOWN)), payload_id, F.lit(UNKNOWN))


def sensor_of_device(device: Column) -> Column:
    """First sensor whose name part occurs in the device id, in any case; null for none."""
    name = F.lower(device)
    chain = None
    for sensor, parts in settings.DEVICE_PARTS:
        hit = name.contains(parts[0])
        for part in parts[1:]:
            hit = hit | name.contains(part)
        chain = F.when(hit, sensor) if chain is None else chain.when(hit, sensor)
    return chain


def sensor_of_topic(topic: Column, prefix: str) -> Column:
    """Sensor named by a topic; null for any other topic."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for sensor, _ in settings.DEVICE_PARTS:
        chain = chain.when(topic == f"{prefix}-{sensor}", sensor)
    return chain

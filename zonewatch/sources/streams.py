"""Message streams. Every source yields ``value`` (bytes or text) and, where known, ``topic``.

The transport is a parameter: ``kafka`` in production, files where there is no broker.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch import settings
from zonewatch.functions import routing
from zonewatch.operators import alerts, parse
from zonewatch.sensors import SENSORS, Sensor, alert_topic, topic_of

HUB_DEVICE_HEADER = "iothub-connection-device-id"
#: What a message is, whatever carries it; ``timestamp`` is when it arrived.
MESSAGE = "key binary, value binary, topic string, headers array<struct<key: string, value: binary>>, timestamp timestamp"


@dataclass(frozen=True)
class Folder:
    """Topics as folders of message files, in place of a broker. Every call of ``publish`` has a folder of its own in that of
    its topic: two jobs that commit to one folder at a time remove each other's files."""

    path: str
    files_per_batch: int | None = None

    def read(self, spark: SparkSession, topics, **more: str) -> DataFrame:
        names = [topics] if isinstance(topics, str) else list(topics)
        options = {"recursiveFileLookup": "true"}
        if self.files_per_batch is not None:
            options["maxFilesPerTrigger"] = str(self.files_per_batch)
        return messages(spark, "parquet", options, f"{self.path}/{{{','.join(names)}}}", MESSAGE)

    def publish(self, rows: DataFrame, topic: str, arrival=None) -> None:
        """Rows with ``value`` and, where they have them, ``key``, ``headers`` and ``timestamp``, as messages of a topic."""
        stamp = F.current_timestamp() if arrival is None else arrival
        given = {"topic": F.lit(topic), "timestamp": F.col("timestamp") if "timestamp" in rows.columns else stamp}
        for name in ("key", "headers"):
            kind = "binary" if name == "key" else "array<struct<key: string, value: binary>>"
            given[name] = F.col(name) if name in rows.columns else F.lit(None).cast(kind)
        found = rows.withColumns(given).withColumn("value", F.col("value").cast("binary"))
        found.select("key", "value", "topic", "headers", "timestamp").write.parquet(f"{self.path}/{topic}/sent=p{uuid.uuid4().hex}")


def kafka_options(servers: str, topics, starting: str = "latest", **more: str) -> dict[str, str]:
    names = [topics] if isinstance(topics, str) else list(topics)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting,
        **more,
    }


def messages(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None, schema=None) -> DataFrame:
    """Any streaming source, unparsed."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def subscribed(spark: SparkSession, where: str | Folder, topics, **more: str) -> DataFrame:
    """Messages of topics, from the latest offset of a broker or from the files of a folder."""
    if isinstance(where, Folder):
        return where.read(spark, topics)
    return messages(spark, "kafka", kafka_options(where, topics, **more))


def sensor_topic(spark: SparkSession, where: str | Folder, sensor: Sensor, prefix: str = settings.TOPIC_PREFIX) -> DataFrame:
    """Typed readings of one sensor topic."""
    return parse.decode(subscribed(spark, where, topic_of(sensor.name, prefix)), sensor)


def all_topics(spark: SparkSession, where: str | Folder, prefix: str = settings.TOPIC_PREFIX, text: bool = False) -> DataFrame:
    """Readings of all sensors from one subscription; the topic names the sensor."""
    return from_topics(subscribed(spark, where, [topic_of(name, prefix) for name in SENSORS]), prefix, text)


def from_topics(stream: DataFrame, prefix: str = settings.TOPIC_PREFIX, text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings from messages with a ``topic``; other topics and non-objects are left to ``parse.unread``."""
    return parse.decode_any(stream, routing.sensor_of_topic(F.col("topic"), prefix), text, keep)


def alert_messages(spark: SparkSession, where: str | Folder, prefix: str = settings.TOPIC_PREFIX, group: str | None = None, keep: tuple[str, ...] = ()):
    """Alert records from the alert topic; ``keep`` of the message, such as its arrival ``timestamp``, goes with them."""
    more = {"kafka.group.id": group} if group else {}
    return alerts.unpacked(subscribed(spark, where, alert_topic(prefix), **more), keep)


def hub_events(spark: SparkSession, where: str | Folder, topic: str) -> DataFrame:
    """Device-hub events over its Kafka endpoint: body plus the hub's device id."""
    return hub_device(subscribed(spark, where, topic, includeHeaders="true"))


def hub_device(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, ``value`` and ``hub_device_id``, taken from the message headers; null when there is none."""
    header = F.filter("headers", lambda h: h["key"] == HUB_DEVICE_HEADER)
    device = F.try_element_at(header, F.lit(1))["value"].cast("string")
    return events.select(*keep, "value", device.alias("hub_device_id"))

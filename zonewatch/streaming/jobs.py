"""Streaming jobs. A pipeline is two queries per sensor, alerts and trends."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from zonewatch import settings
from zonewatch.operators import alerts as ops
from zonewatch.functions import routing
from zonewatch.operators import bridge, parse, points, rollups, windows
from zonewatch.sensors import Sensor, alert_topic
from zonewatch.session import prepare
from zonewatch.sources import tables
from zonewatch.sources.streams import Folder
from zonewatch.streaming import sinks
from zonewatch.streaming.incidents import incident_events
from zonewatch.streaming.store import PointStore


#: A folder per micro-batch is replaced as a whole, whatever the session's own mode is.
STATIC = ("partitionOverwriteMode", "static")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of its own for stateful queries; their state is kept off the heap, with only its changes
    written per micro-batch.

    ``state_partitions`` is their shuffle width, fixed in the checkpoint at the first start. Every
    partition commits a state store per micro-batch, so a live stream takes as many as its open groups
    (zones x windows under the watermark) need, a few for some thousand zones, and a backfill,
    which holds a whole history in one micro-batch, as many as the cluster has cores.
    """
    own = prepare(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


def _start(writer: DataStreamWriter, name: str, trigger: dict | None) -> StreamingQuery:
    return writer.queryName(name).trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def alert_pipeline(
    readings: DataFrame | dict[str, DataFrame],
    sensors: tuple[Sensor, ...],
    point_path: str | PointStore,
    checkpoint: str,
    message_fmt: str = "kafka",
    message_options: dict[str, str] | Folder | None = None,
    show: bool = False,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Alerts to messages and points, trends to points: two queries per sensor.

    Each sensor has watermarks, state and checkpoints of its own, so a topic that lags, or a device whose
    clock runs ahead, holds up or cuts off no other sensor. ``readings`` is one stream of
    all sensors, or a stream per sensor name.
    """
    started = []
    for sensor in sensors:
        own = readings[sensor.name] if isinstance(readings, dict) else readings
        alert_rows, trend_rows = windows.alert_pipeline(own, (sensor,))
        outputs = [sinks.point_batches(point_path, f"alerts_{sensor.name}")]
        if isinstance(message_options, Folder):
            outputs.insert(0, sinks.topic_batches(message_options, alert_topic()))
        elif message_options is not None:
            outputs.insert(0, sinks.message_batches(message_fmt, _own_folder(message_options, sensor)))
        if show:
            outputs.append(sinks.show_batches())
        trends = [sinks.point_batches(point_path, f"trends_{sensor.name}")]
        for kind, rows, targets in (("alerts", alert_rows, outputs), ("trends", trend_rows, trends)):
            writer = rows.writeStream.foreachBatch(sinks.fan_out(*targets)).outputMode("append")
            writer = writer.option("checkpointLocation", f"{checkpoint}/{kind}_{sensor.name}")
            started.append(_start(writer, f"{kind}_{sensor.name}", trigger))
    return started


def _own_folder(options: dict[str, str], sensor: Sensor) -> dict[str, str]:
    """Messages into files go to a folder per sensor: two jobs cannot commit to one folder at a time."""
    return options | {"path": f"{options['path']}/sensor={sensor.name}"} if "path" in options else options


def reject_log(messages: DataFrame, path: str, checkpoint: str, prefix: str = settings.TOPIC_PREFIX, trigger: dict | None = None) -> StreamingQuery:
    """Messages of the sensor topics that give no reading, with their raw text and reason."""
    rejected = parse.unread(messages, routing.sensor_of_topic(F.col("topic"), prefix), keep=("topic",))
    return _start(sinks.reject_table(rejected, path, checkpoint), "rejects", trigger)


def reading_points(
    readings: DataFrame, sensors: tuple[Sensor, ...], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Raw readings to the point table."""
    rows = points.reading_points(readings, sensors)
    return _start(sinks.reading_point_table(rows, path, checkpoint), "reading_points", trigger)


def device_bridge(
    events: DataFrame,
    message_writer,
    letter_path: str,
    checkpoint: str,
    prefix: str = settings.TOPIC_PREFIX,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Device events to their sensor topics; dead letters of unknown devices to a table.

    ``message_writer(batch, batch_id)`` takes rows with ``topic`` and ``value``.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        taken, letters = bridge.split_routes(batch, prefix)
        message_writer(taken, batch_id)
        letters.write.mode("overwrite").option(*STATIC).parquet(f"{letter_path}/batch={batch_id}")

    writer = events.writeStream.foreachBatch(sinks.fan_out(route)).option("checkpointLocation", checkpoint)
    return _start(writer, "device_bridge", trigger)


def alert_engine(
    records: DataFrame,
    point_path: str,
    outbox_path: str,
    checkpoint: str,
    notify: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Alert messages to points at arrival time, and red ones to the outbox when notification is on."""

    def outbox(batch: DataFrame, batch_id: int) -> None:
        if notify:
            ops.outbox(batch, enabled=True).write.mode("overwrite").option(*STATIC).parquet(f"{outbox_path}/batch={batch_id}")

    def arrived(batch: DataFrame, batch_id: int) -> None:
        arrival = F.lit(sinks.fixed_arrival(batch.sparkSession, point_path, batch_id)).cast("timestamp")
        sinks.write_batch(points.arrival_points(batch, arrival), point_path, "arrivals", batch_id)

    writer = (
        ops.serving(records)
        .writeStream.foreachBatch(sinks.fan_out(arrived, outbox))
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, "alert_engine", trigger)


def alert_counts(records: DataFrame, sink_fmt: str, name: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Running counts per level and in total since the start, refreshed every minute."""
    writer = ops.counts(records).writeStream.format(sink_fmt).outputMode("complete")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _start(writer, name, trigger or {"processingTime": "60 seconds"})


def incidents(records: DataFrame, gap: str = settings.INCIDENT_GAP, delay: str = "5 minutes") -> DataFrame:
    """Incidents from alert messages, each emitted once when it is over."""
    red = (F.col("alert_level") == settings.RED).cast("long")
    ended = (
        ops.serving(records)
        .withWatermark("debut_fenetre", delay)
        .groupBy(F.session_window("debut_fenetre", gap).alias("session"), *ops.INCIDENT_KEYS)
        .agg(
            F.max("fin_fenetre").alias("fin"),
            F.count(F.lit(1)).alias("nb_fenetres"),
            F.sum(red).alias("nb_rouge"),
            F.max("valeur_detectee").alias("valeur_max"),
        )
    )
    return ended.select(
        *ops.INCIDENT_KEYS,
        F.col("session.start").alias("debut"),
        "fin",
        F.col("session.end").alias("resolu"),
        "nb_fenetres",
        "nb_rouge",
        "valeur_max",
    )


def incident_log(
    records: DataFrame, path: str, checkpoint: str, gap: str = settings.INCIDENT_GAP, silence: str = settings.INCIDENT_GAP, trigger: dict | None = None
) -> StreamingQuery:
    """Incidents that open and end, also when the alerts fall silent. Micro-batches go on without input, or no
    timer would fire; so ``availableNow``, which waits for the last of them, is no trigger for this query."""
    events = incident_events(records, gap, silence)
    writer = events.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, "incidents", trigger or {"processingTime": "1 second"})


def rolled_points(
    readings: DataFrame, sensors: tuple[Sensor, ...], store: PointStore, rollup: PointStore, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Readings to points, and beside them to minute rollups; both from one pass over a micro-batch."""
    targets = (store.batches("points"), rollup.batches("minutes", rollups.partials))
    rows = points.reading_points(readings, sensors)
    writer = rows.writeStream.foreachBatch(sinks.fan_out(*targets)).option("checkpointLocation", checkpoint)
    return _start(writer, "rolled_points", trigger)


def point_stores(spark: SparkSession, root: str) -> tuple[PointStore, PointStore]:
    """(reading points, their minute rollups) below one folder."""
    kinds = "measurement string, zone string, device_id string, field string, value double, time timestamp"
    return PointStore(spark, f"{root}/points", kinds), PointStore(spark, f"{root}/minutes", rollups.SCHEMA, "minute", rollups.merged)


def alert_store(spark: SparkSession, root: str) -> PointStore:
    """A store for alert and trend points."""
    return PointStore(spark, root, "time timestamp, zone string, niveau string, type string, valeur double, source string")


def alert_routing(records: DataFrame, route_path: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Alerts with the routes that hold when their micro-batch is taken: the newest version of a table of versions."""

    def rows(batch: DataFrame) -> DataFrame:
        return ops.routed(batch, tables.newest_version(batch.sparkSession, route_path, ops.ROUTE_SCHEMA))

    writer = records.writeStream.foreachBatch(sinks.fan_out(sinks.replaced_batches(path, rows)))
    return _start(writer.option("checkpointLocation", checkpoint), "alert_routing", trigger)


def latency_log(records: DataFrame, arrival: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Latencies of alerts by the time ``arrival`` that their messages carry, as partials per micro-batch."""
    writer = records.writeStream.foreachBatch(sinks.replaced_batches(path, lambda batch: ops.latency_partials(batch, F.col(arrival))))
    return _start(writer.option("checkpointLocation", checkpoint), "latency_log", trigger)


def settled(query: StreamingQuery, seconds: float = 300, state: bool = False) -> None:
    """Waits until a query has taken its input and, unless it may keep ``state``, holds none any more; then stops it."""
    until, taken = time.monotonic() + seconds, False
    while time.monotonic() < until:
        if not query.isActive:
            return drain(query)
        for p in query.recentProgress:
            taken = taken or p["numInputRows"] > 0
        last = query.lastProgress
        if taken and last["numInputRows"] == 0 and (state or not sum(s["numRowsTotal"] for s in last["stateOperators"])):
            return query.stop()
        time.sleep(0.3)
    query.stop()
    raise TimeoutError("the query did not settle")


def supervise(spark: SparkSession) -> None:
    """Wait until any query ends; its error, if it has one, is raised here."""
    spark.streams.awaitAnyTermination()


def drain(query: StreamingQuery) -> None:
    """Wait for a query started with ``availableNow`` to work off its input."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()

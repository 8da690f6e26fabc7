"""Streaming sinks. Writes run in the executors; nothing is collected.

``foreachBatch`` sinks replace what the same micro-batch wrote before, so a repeated batch after a
failure leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from zonewatch.operators import alerts as ops
from zonewatch.operators import points
from zonewatch.sources import tables
from zonewatch.sources.streams import Folder
from zonewatch.streaming.store import PointStore

BatchSink = Callable[[DataFrame, int], None]


def alert_log(
    alert_rows: DataFrame, fmt: str, options: dict[str, str], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Alerts as JSON messages: a Kafka topic, or text files without a broker.

    ``append`` sends a window once, when it is over. ``update`` sends it early and again with every
    change, for a receiver that keeps the last message per window; file sinks do not take it.
    """
    return (
        ops.packed(ops.records(alert_rows))
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )


def console(rows: DataFrame, checkpoint: str | None = None) -> DataStreamWriter:
    writer = rows.writeStream.format("console").option("truncate", "false").option("numRows", "20")
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).outputMode("append")


def write_batch(rows: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Replace one micro-batch's rows of one query in a point table laid out by day.

    The day comes first, so a panel over recent points lists the folders of its days only; query and
    batch follow, so a repeated batch replaces its own rows and no others. A day's rows are
    dealt by a shuffle to as many tasks as the session has shuffle partitions, without a count.
    """
    dated = rows.withColumns({"date": F.to_date("time"), "query": F.lit(query), "batch": F.lit(batch_id)})
    (
        dated.repartition("date", "zone")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "query", "batch")
        .parquet(path)
    )


def fixed_arrival(spark: SparkSession, path: str, batch_id: int) -> datetime:
    """The arrival time of a micro-batch. It is noted before the batch is written, so that a repeated
    batch has the same times, and with them the same days."""
    note = f"{path}/_arrivals/batch={batch_id}"
    known = tables.table_or_none(spark, note, "arrival timestamp")
    if known is None:
        spark.range(1).select(F.current_timestamp().alias("arrival")).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(note)
        known = tables.table_or_none(spark, note, "arrival timestamp")
    return known.first()[0]


def point_batches(where: str | PointStore, query: str, to_points=points.alert_points) -> BatchSink:
    """Micro-batches of alerts or trends into a point table, or into a store that compacts them."""
    if isinstance(where, PointStore):
        return where.batches(query, to_points)
    return lambda batch, batch_id: write_batch(to_points(batch), where, query, batch_id)


def topic_batches(folder: Folder, topic: str) -> BatchSink:
    """Micro-batches of alerts as messages of a topic in files (delivered at least once)."""
    return lambda batch, batch_id: folder.publish(ops.as_messages(ops.records(batch), topic), topic)


def replaced_batches(path: str, to_rows: Callable[[DataFrame], DataFrame]) -> BatchSink:
    """Micro-batches into a folder each, which a repeated batch replaces."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        to_rows(batch).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}")

    return sink


def message_batches(fmt: str, options: dict[str, str]) -> BatchSink:
    """Micro-batches of alerts as JSON messages (delivered at least once)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        ops.packed(ops.records(batch)).write.format(fmt).options(**options).mode("append").save()

    return sink


def show_batches(rows: int = 20) -> BatchSink:
    return lambda batch, batch_id: batch.show(rows, truncate=False)


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Several sinks on one query: one source read, one state, one pass over the batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for write in sinks:
                write(kept, batch_id)
        finally:
            kept.unpersist()

    return sink


def reject_table(rejected: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Messages that gave no reading, with their raw text, by reason."""
    return (
        rejected.writeStream.format("parquet")
        .partitionBy("reject_reason")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def raw_landing(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Messages (``value``, ``sensor``) to the raw zone as JSON lines, a folder per sensor."""
    return (
        messages.select(F.col("value").cast("string").alias("value"), F.col("sensor").alias("sensor_type"))
        .writeStream.format("text")
        .partitionBy("sensor_type")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def reading_point_table(reading_points: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Reading points to a table laid out for the dashboards: by measurement and day."""
    return (
        reading_points.withColumn("date", F.to_date("time"))
        .writeStream.format("parquet")
        .partitionBy("measurement", "date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )

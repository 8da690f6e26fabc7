"""Batch load: raw files -> processed table -> daily snapshot, with a run log.

A second run over the same raw files adds nothing. Only days that received rows are
aggregated again, because every daily aggregate groups by the partition columns.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonewatch.operators import clean, daily, parse
from zonewatch.sensors import SENSORS, Sensor, chosen
from zonewatch.session import prepare
from zonewatch.sources import tables

SUCCESS = "SUCCESS"
NO_DATA = "SKIPPED_NO_DATA"
LOG_SCHEMA = (
    "timestamp timestamp, sensor_type string, status string, rows_processed long, "
    "duration_seconds double, snapshot_status string"
)


@dataclass(frozen=True)
class Run:
    sensor: str
    status: str
    rows: int
    snapshot: str | None
    seconds: float
    ended: datetime


def _failure(err: Exception) -> str:
    return f"FAILED: {str(err)[:100]}"


def load(lines: DataFrame, lake: str, sensor: Sensor, batch: str) -> int:
    """Clean raw lines and append the new rows; returns their number.

    The parsed batch is staged as a table, so the raw JSON is parsed once: rejects, good rows and days
    are read from there. Rejects are kept per ``batch`` with their raw text, so another batch does not
    replace them and the same one does. The new rows are staged too: their days are marked as owed
    before anything is appended, and a lost executor costs one stage.
    """
    spark, name = lines.sparkSession, sensor.name
    staged = _staged(clean.tagged(parse.decode_lines(lines, sensor)), f"{lake}/staging/{name}/batch")
    _replace(clean.rejects(staged), f"{lake}/rejects/{name}/batch={batch}")
    stored = tables.processed(spark, lake, name)
    good = staged.filter("reject_reason IS NULL")
    known = clean.on_days(stored, good) if stored is not None else None
    counted = Observation("new rows")
    new = clean.new_rows(clean.without_rejects(staged, sensor), known).observe(counted, F.count(F.lit(1)).alias("rows"))
    fresh = _staged(new, f"{lake}/staging/{name}/fresh")
    rows = counted.get["rows"]  # counted as they were written
    if rows:
        days = fresh.select("date_partition").distinct().coalesce(1)
        days.write.mode("append").parquet(f"{lake}/pending/{name}")
        # The rebalance splits a large day and zone over several tasks and joins small ones, so neither
        # a hot zone nor thousands of tiny files come out.
        dealt = fresh.hint("rebalance", *[F.col(c) for c in daily.DAY_KEYS])
        dealt.write.mode("append").partitionBy(*daily.DAY_KEYS).parquet(f"{lake}/processed/{name}")
    return rows


def _replace(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _staged(table: DataFrame, path: str) -> DataFrame:
    _replace(table, path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def pending_days(spark: SparkSession, lake: str, name: str) -> DataFrame | None:
    """Days whose rows were appended but not aggregated yet, ``None`` without any. A run that failed or
    was lost leaves them to the next."""
    return tables.table_or_none(spark, f"{lake}/pending/{name}", tables.DAY_SCHEMA)


def refresh_snapshot(spark: SparkSession, lake: str, name: str, days: DataFrame | None = None) -> None:
    """Rebuild the daily aggregates of the given days, of all days when none are given.

    The snapshot is partitioned by day alone, the unit in which it is replaced: a day and zone
    hold a single row, and a file for each would leave nothing but tiny files.
    """
    history = tables.processed(spark, lake, name) if name in SENSORS else None
    if history is None:
        return
    touched = history if days is None else clean.on_days(history, days)
    day = daily.DAY_KEYS[0]
    result = daily.daily_by_name(touched, name).hint("rebalance", F.col(day))
    (
        result.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(f"{lake}/aggregated/{name}")
    )


def refresh_owed(spark: SparkSession, lake: str, name: str) -> str | None:
    """Aggregate the owed days. Returns how that went, ``None`` if nothing was owed."""
    owed = pending_days(spark, lake, name)
    if owed is None:
        return None
    try:
        refresh_snapshot(spark, lake, name, owed)
    except Exception as err:  # noqa: BLE001 - the load itself stands, the days stay marked
        return _failure(err)
    _replace(spark.createDataFrame([], tables.DAY_SCHEMA), f"{lake}/pending/{name}")
    return SUCCESS


def run_sensor(spark: SparkSession, raw_root: str, lake: str, sensor: Sensor) -> Run:
    """Load one sensor. Failures are reported in the run, so the other sensors still load."""
    begun, status, rows, snapshot = time.monotonic(), SUCCESS, 0, None
    try:
        lines = tables.raw_lines(spark, raw_root, sensor)
        if lines is None:
            status = NO_DATA
        else:
            rows = load(lines, lake, sensor, "all")
            snapshot = refresh_owed(spark, lake, sensor.name)
    except Exception as err:  # noqa: BLE001
        status = _failure(err)
    seconds = round(time.monotonic() - begun, 2)
    return Run(sensor.name, status, rows, snapshot, seconds, datetime.now(timezone.utc))


def log_runs(spark: SparkSession, lake: str, runs: list[Run]) -> None:
    rows = [(r.ended, r.sensor, r.status, r.rows, r.seconds, r.snapshot) for r in runs]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{lake}/run_log")


def run_all(spark: SparkSession, raw_root: str, lake: str, names=None) -> list[Run]:
    """Load all sensors side by side and append the run log. The loads share no table."""
    prepare(spark)
    sensors = chosen(names)
    with ThreadPoolExecutor(len(sensors)) as pool:
        runs = list(pool.map(lambda s: run_sensor(spark, raw_root, lake, s), sensors))
    log_runs(spark, lake, runs)
    return runs


def load_new_files(spark: SparkSession, raw_root: str, lake: str, sensor: Sensor, checkpoint: str) -> None:
    """The same load over the raw files that arrived since the last call, for an hourly schedule.

    Days that an earlier call left without aggregates are made up for first. Every batch is logged, and a call that finds
    no new files or no folder too; a failed load or snapshot is raised after that, and a failed load is taken up
    again by the next call.
    """
    begun, taken = time.monotonic(), []
    prepare(spark)
    _raise(refresh_owed(spark, lake, sensor.name))

    def take(batch: DataFrame, batch_id: int) -> None:
        begun, rows, snapshot, failed = time.monotonic(), 0, None, None
        try:
            rows = load(tables.filled(batch), lake, sensor, str(batch_id))
            snapshot = refresh_owed(spark, lake, sensor.name)
        except Exception as err:
            failed = err
        status = SUCCESS if failed is None else _failure(failed)
        seconds = round(time.monotonic() - begun, 2)
        log_runs(spark, lake, [Run(sensor.name, status, rows, snapshot, seconds, datetime.now(timezone.utc))])
        taken.append(batch_id)
        if failed is not None:
            raise failed
        _raise(snapshot)

    try:
        stream = spark.readStream.text(tables.raw_path(raw_root, sensor.name))
        query = (
            stream.writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    except AnalysisException as err:
        if err.getCondition() not in tables.ABSENT:
            raise
    if not taken:
        seconds = round(time.monotonic() - begun, 2)
        log_runs(spark, lake, [Run(sensor.name, NO_DATA, 0, None, seconds, datetime.now(timezone.utc))])


def _raise(snapshot: str | None) -> None:
    if snapshot not in (None, SUCCESS):
        raise RuntimeError(f"snapshot {snapshot}")

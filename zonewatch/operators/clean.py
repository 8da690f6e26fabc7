"""Cleaning and idempotent ingest of stored readings."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.operators import parse
from zonewatch.sensors import ID_COLUMNS, Sensor


def one_per_key(readings: DataFrame, keys, prefer) -> DataFrame:
    """One row per key: the one with most ``prefer`` columns filled, then the greatest by value.

    A plain aggregate, so copies of a hot key collapse in every task before the shuffle;
    the choice depends on the rows only, never on their order.
    """
    rest = [c for c in readings.columns if c not in keys]
    filled = reduce(add, [F.col(c).isNotNull().cast("int") for c in prefer])
    best = F.max(F.struct(filled.alias("filled"), *rest)).alias("best")
    return readings.groupBy(*keys).agg(best).select(*keys, *[f"best.{c}" for c in rest])


def tagged(readings: DataFrame) -> DataFrame:
    """Readings with day, hour and the reason for which they cannot be stored, null for good rows."""
    reason = parse.reject_reason(numbers="bad_number" in readings.columns)
    return parse.with_calendar(readings).withColumn("reject_reason", reason)


def rejects(tagged_rows: DataFrame) -> DataFrame:
    bad = tagged_rows.filter(F.col("reject_reason").isNotNull())
    return bad.drop("event_time", "date_partition", "heure")


def without_rejects(tagged_rows: DataFrame, sensor: Sensor) -> DataFrame:
    """Good keys and time, one row per key, and only then the test for required metrics."""
    good = tagged_rows.filter(F.col("reject_reason").isNull()).drop("reject_reason", "event_time", "value", "bad_number")
    return one_per_key(good, ID_COLUMNS, sensor.required).dropna(how="any", subset=list(sensor.required))


def clean(readings: DataFrame, sensor: Sensor) -> DataFrame:
    return without_rejects(tagged(readings), sensor)


def new_rows(cleaned: DataFrame, stored: DataFrame | None, keys=ID_COLUMNS) -> DataFrame:
    """Rows whose key is not stored yet. ``None`` means nothing is stored."""
    if stored is None:
        return cleaned
    return cleaned.join(stored.select(*keys), on=list(keys), how="left_anti")


def on_days(stored: DataFrame, days: DataFrame) -> DataFrame:
    """Stored rows of the days in ``days`` (``date_partition``) only. The day follows from the time in the
    key, so other days cannot hold a key of the batch. The days are a table, joined: its rows prune
    the partitions that are read, and none of them passes through the driver."""
    # The filter marks the side as selective, without which no partitions are pruned.
    wanted = days.select("date_partition").distinct().filter("date_partition >= date'0001-01-01'")
    return stored.join(wanted, "date_partition", "left_semi")

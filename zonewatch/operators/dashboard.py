"""Dashboard queries over point tables. ``now`` is always given, so results can be repeated.

A series is one (measurement, zone, device, field). Time buckets carry their start. Panels take points, or the partial
sums of ``rollups`` in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonewatch.functions import bands
from zonewatch.sensors import SERIES
from zonewatch.settings import ALERT_TABLE_LABELS, ORANGE, RED

ALERT_SERIES = ("zone", "niveau", "type")


def in_range(points: DataFrame, now: Column, back: str) -> DataFrame:
    """Points from ``now - back`` (included) to ``now`` (excluded). On a table laid out by ``date`` only the
    days of the range are listed and read."""
    begin = now - F.expr(f"INTERVAL {back}")
    if "date" in points.columns:
        points = points.filter(F.col("date").between(F.to_date(begin), F.to_date(now)))
    return points.filter((F.col("time") >= begin) & (F.col("time") < now))


def of(points: DataFrame, measurement: str, *fields: str) -> DataFrame:
    return points.filter((F.col("measurement") == measurement) & F.col("field").isin(*fields))


def bucket_means(points: DataFrame, every: str) -> DataFrame:
    """Tumbling mean per series; empty buckets give no row."""
    mean = F.try_divide(F.sum("total"), F.sum("n")) if "total" in points.columns else F.avg("value")
    means = points.groupBy(F.window("time", every).alias("bucket"), *SERIES).agg(mean.alias("value"))
    return means.select(F.col("bucket.start").alias("time"), *SERIES, "value")


def latest(points: DataFrame) -> DataFrame:
    """Last non-null value per series; of several at the same time the greatest."""
    if "total" in points.columns:
        points = points.select(*SERIES, F.col("last_time").alias("time"), F.col("last_value").alias("value"))
    last = F.max(F.struct("time", "value")).alias("last")
    found = points.filter(F.col("value").isNotNull()).groupBy(*SERIES).agg(last)
    return found.select(*SERIES, "last.time", "last.value")


def latest_bucket(means: DataFrame) -> DataFrame:
    """Last bucket per series. Buckets are unique in time, so two fixed-width aggregates do."""
    found = means.groupBy(*SERIES).agg(F.max("time").alias("time"), F.max_by("value", "time").alias("value"))
    return found.select(*SERIES, "time", "value")


def with_colour(rows: DataFrame) -> DataFrame:
    return rows.withColumn("colour", bands.field_colour(F.col("field"), F.col("value")))


def aqi_panel(points: DataFrame, now: Column) -> DataFrame:
    recent = in_range(of(points, "pollution", "aqi"), now, "15 minutes")
    return with_colour(latest_bucket(bucket_means(recent, "1 minute")))


def traffic_panel(points: DataFrame, now: Column) -> DataFrame:
    recent = in_range(of(points, "traffic", "vehicles_per_min"), now, "30 minutes")
    return with_colour(bucket_means(recent, "1 minute"))


def pollution_panel(points: DataFrame, now: Column) -> DataFrame:
    recent = in_range(of(points, "pollution", "co2_ppm", "pm25"), now, "30 minutes")
    return bucket_means(recent, "1 minute").withColumn("label", bands.field_label(F.col("field")))


def fill_panel(points: DataFrame, now: Column) -> DataFrame:
    return with_colour(latest(in_range(of(points, "dechets", "fill_percent"), now, "1 hour")))


def lighting_panel(points: DataFrame, now: Column) -> DataFrame:
    """Fault rate and power draw: the mean of the 0/1 fault field is the share of faulty readings."""
    recent = in_range(of(points, "eclairage", "faulty_count", "power_kw"), now, "30 minutes")
    return with_colour(latest_bucket(bucket_means(recent, "5 minutes")))


def pivot_fields(points: DataFrame, fields: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """Fields as columns, one row per key and time. The field list is given, so no pass looks for it."""
    return points.groupBy("time", *keys).pivot("field", list(fields)).agg(F.max("value"))


def active_alerts(alert_points: DataFrame, now: Column) -> DataFrame:
    recent = in_range(alert_points, now, "2 hours")
    return recent.filter(F.col("niveau").isin(RED, ORANGE)).select("time", *ALERT_SERIES, "valeur")


def newest_per_series(alerts: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest alerts of every (zone, level, sensor) table.

    The rank filter is also applied before the shuffle, so no task sends more than ``n`` rows per series.
    """
    order = W.partitionBy(*ALERT_SERIES).orderBy(F.desc("time"), F.desc("valeur"))
    return alerts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def newest(alerts: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest alerts over all series."""
    return alerts.orderBy(F.desc("time"), *ALERT_SERIES, F.desc("valeur")).limit(n)


def alert_table(alerts: DataFrame) -> DataFrame:
    """The alert table with its display names and level colour, newest first."""
    shown = alerts.orderBy(F.desc("time"))
    return shown.select(
        *[F.col(name).alias(label) for name, label in ALERT_TABLE_LABELS.items()],
        bands.level_colour(F.col("niveau")).alias("colour"),
    )

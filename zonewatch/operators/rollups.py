"""Minute rollups of reading points: sums that can be added up, kept beside the points.

A partial is what some points of one series and minute come to: their number, sum, first time, and last time with its
value. Partials of a minute add up in any order and number, so a micro-batch writes its own without looking at
others, a late point is one more partial, and compaction adds up what there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.sensors import SERIES

SCHEMA = (
    "measurement string, zone string, device_id string, field string, minute timestamp, time timestamp, "
    "n long, total double, last_time timestamp, last_value double"
)
COLUMNS = (*SERIES, "minute", "time", "n", "total", "last_time", "last_value")


def partials(points: DataFrame) -> DataFrame:
    """Points with a time and a value, added up per series and minute; ``time`` is the first point's."""
    known = points.filter("time IS NOT NULL AND value IS NOT NULL").withColumn("minute", F.date_trunc("minute", "time"))
    # Fixed-width sums and maxima only: among points of one time the greatest value is the last one.
    totals = known.groupBy(*SERIES, "minute").agg(
        F.min("time").alias("time"),
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total"),
        F.max(F.struct("time", "value")).alias("last"),
    )
    return totals.select(*SERIES, "minute", "time", "n", "total", F.col("last.time").alias("last_time"), F.col("last.value").alias("last_value"))


def merged(rows: DataFrame) -> DataFrame:
    """Partials of the same series and minute as one."""
    totals = rows.groupBy(*SERIES, "minute").agg(
        F.min("time").alias("time"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max(F.struct("last_time", "last_value")).alias("last"),
    )
    return totals.select(*SERIES, "minute", "time", "n", "total", "last.last_time", "last.last_value")


def near(rollup: DataFrame, points: DataFrame, now: Column, back: str) -> DataFrame:
    """Partials of exactly the points from ``now - back`` to ``now``: whole minutes from the rollup, the two minutes that the
    range cuts from the points."""
    begin = now - F.expr(f"INTERVAL {back}")
    first, last = F.date_trunc("minute", begin), F.date_trunc("minute", now)
    whole = rollup.filter((F.col("minute") > first) & (F.col("minute") < last))
    cut = points.filter((F.col("time") >= begin) & (F.col("time") < now))
    cut = cut.filter((F.col("time") < first + F.expr("INTERVAL 1 minute")) | (F.col("time") >= last))
    if "date" in rollup.columns:
        days = F.col("date").between(F.to_date(begin), F.to_date(now))
        whole, cut = whole.filter(days), cut.filter(days)
    return whole.select(*COLUMNS).unionByName(partials(cut))

"""Sliding zone windows: the same columns from a bounded table and from a stream.

Batch: a reading is aggregated once, into its pane (a tumbling window as long as
the slide), and only the panes are copied into the windows that cover them. The
sliding copies therefore cost a row per pane and zone instead of a row per reading.

Stream: one ``window()`` aggregation, whose state and late-row rule are per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.functions import grading
from zonewatch.functions.stats import GRADING_PLACES
from zonewatch.sensors import FAULTY, Sensor, case_by_sensor
from zonewatch.settings import ALERT_WINDOW, GREEN, TREND, TREND_WINDOW

KEYS = ("sensor", "zone")


def _slots(sensors) -> list[str]:
    """The sensors' averaged fields laid over each other: slot 0 holds each sensor's first field,
    and so on. Mixed sensors then need as many running sums as the widest one, not as all together."""

    def field(sensor: Sensor, place: int) -> str:
        fields = list(sensor.averages.values())
        return f"double({fields[place]})" if place < len(fields) else "double(NULL)"

    width = max(len(s.averages) for s in sensors)
    return [case_by_sensor(lambda s, i=i: field(s, i), sensors) for i in range(width)]


def _faults(sensors) -> list[str]:
    """Fault counter, null for sensors that do not report faults; none if no sensor does."""
    if not any(s.counts_faults for s in sensors):
        return []
    faults = case_by_sensor(lambda s: FAULTY if s.counts_faults else "CAST(NULL AS INT)", sensors)
    return [f"sum({faults}) AS nb_faulty"]


def _named(rows: DataFrame, sensors, start: str, end: str) -> DataFrame:
    """Slots back under the sensors' own metric names, rounded; a metric is null on other sensors' rows."""
    metrics = []
    for sensor in sensors:
        for place, metric in enumerate(sensor.averages):
            mean = f"round(m{place}, {GRADING_PLACES})"
            if len(sensors) > 1:
                mean = f"CASE WHEN sensor = '{sensor.name}' THEN {mean} END"
            metrics.append(f"{mean} AS {metric}")
    faults = ["nb_faulty"] if "nb_faulty" in rows.columns else []
    return rows.selectExpr(f"{start} AS window_start", f"{end} AS window_end", *KEYS, "nb_mesures", *metrics, *faults)


def _grouped(rows: DataFrame, window, totals: list[str]) -> DataFrame:
    return rows.groupBy(window, *KEYS).agg(*[F.expr(t) for t in totals])


def batch_windows(readings: DataFrame, sensors: tuple[Sensor, ...], size: str, slide: str) -> DataFrame:
    """Windows over a bounded table: panes first, then windows over panes."""
    slots, faults = _slots(sensors), _faults(sensors)
    pane = F.window("event_time", slide).start.alias("pane_start")
    sums = [f"sum({field}) AS s{i}" for i, field in enumerate(slots)]
    counts = [f"count({field}) AS n{i}" for i, field in enumerate(slots)]
    panes = _grouped(readings, pane, ["count(1) AS n", *sums, *counts, *faults])

    means = [f"try_divide(sum(s{i}), sum(n{i})) AS m{i}" for i in range(len(slots))]
    again = ["sum(nb_faulty) AS nb_faulty"] if faults else []
    windows = _grouped(panes, F.window("pane_start", size, slide), ["sum(n) AS nb_mesures", *means, *again])
    return _named(windows, sensors, "window.start", "window.end")


def stream_windows(
    readings: DataFrame, sensors: tuple[Sensor, ...], size: str, slide: str, delay: str
) -> DataFrame:
    """Windows over a stream, emitted once each after the watermark passes their end."""
    means = [f"avg({field}) AS m{i}" for i, field in enumerate(_slots(sensors))]
    marked = readings.withWatermark("event_time", delay)
    totals = ["count(1) AS nb_mesures", *means, *_faults(sensors)]
    windows = _grouped(marked, F.window("event_time", size, slide), totals)
    return _named(windows, sensors, "window.start", "window.end")


def zone_windows(readings: DataFrame, sensors: tuple[Sensor, ...], size: str, slide: str, delay: str) -> DataFrame:
    """Windows of a table or a stream. All sensors share one scan and one aggregation.

    ``readings`` needs ``sensor``, ``zone``, ``event_time`` and the sensors' fields.
    """
    ours = readings.filter(F.col("sensor").isin([s.name for s in sensors]))
    if readings.isStreaming:
        return stream_windows(ours, sensors, size, slide, delay)
    return batch_windows(ours, sensors, size, slide)


def graded(windows: DataFrame, sensors: tuple[Sensor, ...]) -> DataFrame:
    """Every window with level, text, sensor label and headline value."""
    level = case_by_sensor(grading.severity, sensors)
    text = case_by_sensor(grading.message, sensors)
    headline = case_by_sensor(lambda s: s.headline, sensors)
    return windows.selectExpr("*", f"{level} AS alert_level").selectExpr(
        "*", f"{text} AS alert_message", "sensor AS type_capteur", f"{headline} AS valeur_detectee"
    )


def alerts(
    readings: DataFrame, sensors: tuple[Sensor, ...], min_count: int = 1, grade=None
) -> DataFrame:
    """Short windows above the normal level.

    ``min_count`` can hold back windows with few readings; ``grade`` replaces the built-in
    grading by any DataFrame function that adds ``alert_level``.
    """
    found = zone_windows(readings, sensors, *ALERT_WINDOW)
    levels = grade(found) if grade else graded(found, sensors)
    kept = levels.filter(F.col("alert_level") != GREEN)
    return kept.filter(F.col("nb_mesures") >= min_count) if min_count > 1 else kept


def trends(readings: DataFrame, sensors: tuple[Sensor, ...]) -> DataFrame:
    """Every long window as a trend row, without a message."""
    headline = case_by_sensor(lambda s: s.headline, sensors)
    return zone_windows(readings, sensors, *TREND_WINDOW).selectExpr(
        "*", "sensor AS type_capteur", f"{headline} AS valeur_detectee", f"'{TREND}' AS alert_level"
    )


def alert_pipeline(
    readings: DataFrame, sensors: tuple[Sensor, ...], min_count: int = 1, grade=None
) -> tuple[DataFrame, DataFrame]:
    """(alerts over short windows, trends over long windows) of a table or a stream."""
    return alerts(readings, sensors, min_count, grade), trends(readings, sensors)

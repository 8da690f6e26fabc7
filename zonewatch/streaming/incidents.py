"""Incidents as they open and end, on the stream of alerts.

An incident is a run of alert windows of one zone and sensor whose starts lie at most ``gap`` apart. It opens with its
first window and ends in one of two ways: a later window begins beyond the gap, or no alert comes for ``silence`` of
wall-clock time. The second needs no further message: each incident holds a processing-time timer, which fires
even if the whole topic has fallen silent.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from zonewatch import settings
from zonewatch.operators import alerts as ops

OPENED, RESOLVED = "ouvert", "resolu"
STATE = "debut long, dernier long, fin long, nb_fenetres long, nb_rouge long, valeur_max double"
EVENTS = (
    "zone string, type_capteur string, evenement string, debut long, fin long, resolu long, "
    "nb_fenetres long, nb_rouge long, valeur_max double"
)


def micros(interval: str) -> int:
    """An interval of fixed length, such as ``10 minutes``, in microseconds."""
    number, unit = interval.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(float(number) * sizes[unit.rstrip("s")] * 1_000_000)


class Tracker(StatefulProcessor):
    """One series: its open incident, and a timer that ends it.

    Windows may come in any order within a micro-batch; they are joined into runs as they are read, so a task holds no
    more than the runs of a series. Only the last run stays open. A run that came too late to belong to the open
    incident is one of its own, over at once.
    """

    def __init__(self, gap: int, silence_ms: int):
        self.gap, self.silence_ms = gap, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        runs = [Run(*self.open.get(), True)] if self.open.exists() else []
        for row in rows:
            self._add(runs, Run(row.debut, row.debut, row.fin, 1, row.rouge, row.valeur, False))
        for run in runs:
            if not run.known:
                yield _event(key, OPENED, run.debut)
        for run in runs[:-1]:
            yield self._resolved(key, run)
        self.open.update(tuple(runs[-1])[:-1])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            run = Run(*self.open.get(), True)
            self.open.clear()
            yield self._resolved(key, run)

    def close(self) -> None:
        pass

    def _add(self, runs: list[Run], new: Run) -> None:
        """Joins a run with those of ``runs`` (by start, more than the gap apart) that it touches."""
        first = last = bisect(runs, new.debut, key=lambda r: r.debut)
        if first and new.debut <= runs[first - 1].dernier + self.gap:
            first -= 1
            new = _joined(runs[first], new)
        while last < len(runs) and runs[last].debut <= new.dernier + self.gap:
            new = _joined(new, runs[last])
            last += 1
        runs[first:last] = [new]

    def _resolved(self, key, run: Run) -> Row:
        return _event(key, RESOLVED, run.debut, run.fin, run.dernier + self.gap, run.fenetres, run.rouge, run.valeur)


class Run(NamedTuple):
    """Windows of one incident: first and last start, last end, number, red ones, greatest value; ``known`` if it was announced."""

    debut: int
    dernier: int
    fin: int
    fenetres: int
    rouge: int
    valeur: float | None
    known: bool


def _event(key, kind: str, debut: int, fin=None, resolu=None, fenetres=None, rouge=None, valeur=None) -> Row:
    zone, sensor = key
    return Row(
        zone=zone, type_capteur=sensor, evenement=kind, debut=debut, fin=fin, resolu=resolu, nb_fenetres=fenetres, nb_rouge=rouge,
        valeur_max=valeur,
    )


def _joined(a: Run, b: Run) -> Run:
    values = [x for x in (a.valeur, b.valeur) if x is not None]
    return Run(
        min(a.debut, b.debut), max(a.dernier, b.dernier), max(a.fin, b.fin), a.fenetres + b.fenetres, a.rouge + b.rouge,
        max(values, default=None), a.known or b.known,
    )


def incident_events(records: DataFrame, gap: str = settings.INCIDENT_GAP, silence: str = settings.INCIDENT_GAP) -> DataFrame:
    """Events of the incidents in a stream of alert records: ``ouvert`` with its start, ``resolu`` with its totals.

    Records without a window start belong to no incident. State is one row per series with an open incident.
    """
    rows = ops.serving(records).filter("debut_fenetre IS NOT NULL")
    timed = rows.select(
        *ops.INCIDENT_KEYS,
        F.unix_micros("debut_fenetre").alias("debut"),
        F.unix_micros(F.coalesce("fin_fenetre", "debut_fenetre")).alias("fin"),
        (F.col("alert_level") == settings.RED).cast("long").alias("rouge"),
        F.col("valeur_detectee").alias("valeur"),
    )
    events = timed.groupBy(*ops.INCIDENT_KEYS).transformWithState(
        statefulProcessor=Tracker(micros(gap), micros(silence) // 1000),
        outputStructType=StructType.fromDDL(EVENTS),
        outputMode="append",
        timeMode="processingTime",
    )
    times = {name: F.timestamp_micros(name) for name in ("debut", "fin", "resolu")}
    return events.withColumns(times)

"""Health of streaming queries: progress and failures as tables, restart with growing waits.

A query is started by a function, so that it can be started again; it goes on from its checkpoint. Listener calls only
note what they are told; the tables are written by the supervising thread, a few rows per query and flush.
"""

from __future__ import annotations

import queue
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "requete string, execution string, batch long, moment timestamp, lignes long, lignes_par_s double, "
    "duree_ms long, etat_lignes long, filigrane string"
)
INCIDENTS = "requete string, moment timestamp, essai int, evenement string, erreur string"
FAILED, RESTARTED, GIVEN_UP, ENDED = "panne", "reprise", "abandon", "fin"


class ProgressListener(StreamingQueryListener):
    """Notes the progress of named queries."""

    def __init__(self, names):
        self.names, self.noted, self.ended = set(names), queue.SimpleQueue(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name in self.names:
            states = sum(s.numRowsTotal for s in p.stateOperators)
            moment = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
            spent = p.durationMs.get("triggerExecution", 0)
            speed = p.processedRowsPerSecond
            self.noted.put((p.name, str(p.runId), p.batchId, moment, p.numInputRows, speed if speed == speed else None, spent, states, p.eventTime.get("watermark")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def taken(self) -> list[tuple]:
        rows = []
        while not self.noted.empty():
            rows.append(self.noted.get())
        return rows


@dataclass
class Watched:
    start: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    failures: int = 0
    due: float = 0.0
    over: bool = False
    batch: int = -1
    error: str = field(default="", repr=False)


class Supervisor:
    """Keeps queries running. ``starters``: query name -> function that starts it.

    A failed query is started again after ``wait`` seconds, twice as long after each further failure up to ``longest``. A
    micro-batch that succeeds in between resets the count. After ``most`` failures in a row it is given up; the
    others go on, and its error is raised in the end. A query that stops without an error is over.
    """

    def __init__(self, spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]], health: str, wait: float = 1.0, longest: float = 60.0, most: int = 5):
        self.spark, self.health, self.wait, self.longest, self.most = spark, health, wait, longest, most
        self.watched = {name: Watched(start) for name, start in starters.items()}
        self.listener, self.log, self.runs = ProgressListener(starters), [], set()

    def run(self, every: float = 1.0, flush: float = 30.0) -> None:
        """Until all queries are over or given up; raises the error of a query that was given up."""
        self.spark.streams.addListener(self.listener)
        flushed = time.monotonic()
        try:
            while self.step():
                if time.monotonic() - flushed >= flush:
                    self.flush()
                    flushed = time.monotonic()
                time.sleep(every)
        finally:
            self._heard()
            self.spark.streams.removeListener(self.listener)
            self.flush()
        lost = {name: w.error for name, w in self.watched.items() if w.over and w.error}
        if lost:
            raise RuntimeError(f"given up: {lost}")

    def _heard(self, seconds: float = 10.0) -> None:
        """Waits until the listener was told of the end of every run: a run's progress is told before its end, but both come
        a little later than the end itself."""
        until = time.monotonic() + seconds
        while self.runs - self.listener.ended and time.monotonic() < until:
            time.sleep(0.05)

    def step(self) -> bool:
        """Looks at every query once; whether any is left to watch."""
        for name, w in self.watched.items():
            if w.over:
                continue
            if w.query is None:
                if time.monotonic() >= w.due:
                    self._start(name, w)
            elif not w.query.isActive:
                self._ended(name, w, _error(w.query))
            elif (last := w.query.lastProgress) and last["batchId"] > w.batch:
                w.batch, w.failures = last["batchId"], 0
        return not all(w.over for w in self.watched.values())

    def stop(self) -> None:
        for w in self.watched.values():
            if w.query is not None:
                w.query.stop()
            w.over = True

    def _start(self, name: str, w: Watched) -> None:
        if w.failures:
            self._note(name, w, RESTARTED)
        try:
            w.query = w.start()
        except Exception as err:  # noqa: BLE001 - a start that fails is a failure like any other
            self._ended(name, w, str(err))

    def _ended(self, name: str, w: Watched, error: str | None) -> None:
        if w.query is not None:
            self.runs.add(str(w.query.runId))
        w.query = None
        if error is None:
            w.over, w.error = True, ""
            self._note(name, w, ENDED)
            return
        w.failures += 1
        w.error = error
        self._note(name, w, FAILED, error)
        if w.failures >= self.most:
            w.over = True
            self._note(name, w, GIVEN_UP, error)
        else:
            w.due = time.monotonic() + min(self.longest, self.wait * 2 ** (w.failures - 1))

    def _note(self, name: str, w: Watched, event: str, error: str | None = None) -> None:
        self.log.append((name, datetime.now(timezone.utc), w.failures, event, None if error is None else error[:500]))

    def flush(self) -> None:
        """Writes what was noted since the last call."""
        rows, self.log = self.log, []
        for kind, schema, found in (("progress", PROGRESS, self.listener.taken()), ("incidents", INCIDENTS, rows)):
            if found:
                self.spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(f"{self.health}/{kind}")


def _error(query: StreamingQuery) -> str | None:
    try:
        found = query.exception()
    except StreamingQueryException as err:
        found = err
    return None if found is None else str(found)

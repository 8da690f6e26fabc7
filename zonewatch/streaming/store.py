"""A table that micro-batches add to and compaction rewrites, read as one version.

Rows are written to folders that never change, laid out by ``date``. What counts is said by records, one small file
each, that appear and are replaced by renaming:

- ``batch-<query>-<number>``: the folder of a micro-batch. A repeated batch writes a new folder and replaces its record.
- ``merged-<time>-<id>``: a folder that stands for the batches whose numbers it lists, a few ranges per query.

A reader lists the records once and reads their folders; a batch that a merged record covers is left out. A compaction
becomes visible with its one record, so a reader sees the rows before or after it, never both or neither. One compaction runs
at a time; should two cover a batch all the same, the earlier record holds and the later one is passed over as a
whole. Folders that nothing refers to are removed by ``vacuum`` after a time that exceeds any reader's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Record:
    """``covers``: for a merged folder, the batch numbers of each query as [first, last] ranges; ``replaces``: the merged
    records that went into it."""

    name: str
    folder: str
    days: tuple[str, ...]
    query: str | None = None
    number: int | None = None
    covers: dict | None = None
    replaces: tuple[str, ...] = ()

    def has(self, query: str | None, number: int | None) -> bool:
        return any(a <= number <= b for a, b in (self.covers or {}).get(query, ()))


class PointStore:
    """``merge`` is applied to the rows of a day when they are compacted; it must not depend on how they were cut into
    batches. ``time`` names the column that gives the day."""

    def __init__(self, spark: SparkSession, root: str, schema: str, time: str = "time", merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.root, self.schema, self.time, self.merge = spark, root.rstrip("/"), schema, time, merge

    # -- files ------------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):
        path = self._path()
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, folder: str) -> str:
        return f"{self.root}/data/folder={folder}"

    def _names(self, *parts: str) -> list[str]:
        files, path = self._files(), self._path(*parts)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _publish(self, record: Record) -> None:
        """The record appears, or takes the place of the one with its name, by one rename."""
        hidden, path = self._path("records", f".{uuid.uuid4().hex}"), self._path("records", record.name)
        out = self._files().create(hidden, False)
        out.write(json.dumps({k: v for k, v in record.__dict__.items() if k != "name"}).encode())
        out.close()
        fs = self.spark._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        how[0] = getattr(fs, "Options$Rename").OVERWRITE
        fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(hidden, path, how)

    # -- records ----------------------------------------------------------------------------------

    def records(self) -> list[Record]:
        """The records of the newest version."""
        names = [n for n in self._names("records") if not n.startswith(".")]
        if not names:
            return []
        rows = self.spark.read.option("wholetext", True).text(f"{self.root}/records/*").select(F.col("_metadata.file_name").alias("name"), "value").collect()
        return _valid([Record(r.name, **{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(r.value).items()}) for r in rows])

    def _written(self, rows: DataFrame, folder: str, *order: str) -> tuple[str, ...]:
        dated = rows.drop("date").withColumn("date", F.to_date(self.time)).hint("rebalance", F.col("date"))
        dated.sortWithinPartitions("date", *order).write.partitionBy("date").parquet(self._folder(folder))
        return tuple(n.removeprefix("date=") for n in self._names("data", f"folder={folder}") if n.startswith("date="))

    # -- writing ----------------------------------------------------------------------------------

    def append(self, rows: DataFrame, query: str, number: int) -> None:
        """Adds a micro-batch, or replaces what the same micro-batch added before."""
        folder = f"{query}-{number}-{uuid.uuid4().hex}"
        days = self._written(rows, folder)
        self._publish(Record(f"batch-{query}-{number:012d}", folder, days, query, number))

    def batches(self, query: str, to_rows: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
        """As a sink of micro-batches."""
        return lambda batch, batch_id: self.append(to_rows(batch), query, batch_id)

    def compact(self, before: date | None = None, again: bool = False) -> bool:
        """Rewrites the batches whose days all lie before ``before`` (all batches without it) into a few files a day; with
        ``again`` also what earlier compactions made of them. Returns whether there was more than one folder."""
        found = [r for r in self.records() if before is None or all(d < before.isoformat() for d in r.days)]
        old = [r for r in found if again or r.query is not None]
        if len(old) < 2:
            return False
        ranges = [(q, a, b) for r in old for q, parts in (r.covers or {r.query: [[r.number, r.number]]}).items() for a, b in parts]
        covers: dict[str, list[list[int]]] = {}
        for query, a, b in sorted(ranges):
            own = covers.setdefault(query, [])
            if own and own[-1][1] == a - 1:
                own[-1][1] = b
            else:
                own.append([a, b])
        name = f"merged-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
        rows = self._read(old)
        days = self._written(rows if self.merge is None else self.merge(rows), name, self.time) if any(r.days for r in old) else ()
        self._publish(Record(name, name, days, covers=covers, replaces=tuple(r.name for r in old if r.query is None)))
        return True

    def vacuum(self, keep: timedelta = timedelta(days=1)) -> int:
        """Removes folders and batch records that no version since ``keep`` ago refers to; how many folders went."""
        limit = (datetime.now(timezone.utc) - keep).timestamp() * 1000
        current, files, gone = self.records(), self._files(), 0
        names, folders = {r.name for r in current}, {r.folder for r in current}
        for name in self._names("records"):
            path = self._path("records", name)
            if name not in names and files.getFileStatus(path).getModificationTime() < limit:
                files.delete(path, False)
        for folder in self._names("data"):
            path = self._path("data", folder)
            if folder.removeprefix("folder=") not in folders and files.getFileStatus(path).getModificationTime() < limit:
                gone += bool(files.delete(path, True))
        return gone

    # -- reading ----------------------------------------------------------------------------------

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The rows of the newest version with their ``date``; only folders with a day from ``first`` to ``last``."""

        def wanted(day: str) -> bool:
            return (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())

        found = self._read([r for r in self.records() if any(map(wanted, r.days))])
        if first is not None:
            found = found.filter(F.col("date") >= F.lit(first))
        return found if last is None else found.filter(F.col("date") <= F.lit(last))

    def _read(self, records: list[Record]) -> DataFrame:
        folders = [self._folder(r.folder) for r in records if r.days]
        if not folders:
            return self.spark.createDataFrame([], f"{self.schema}, date date")
        reader = self.spark.read.option("basePath", f"{self.root}/data").schema(f"{self.schema}, folder string, date date")
        return reader.parquet(*folders).drop("folder")


def _valid(records: list[Record]) -> list[Record]:
    """Without batches that are covered, merged records that are replaced, and such as cover again what another covers."""
    merged: list[Record] = []
    for r in sorted((r for r in records if r.covers is not None), key=lambda r: r.name):
        if all(m.name in r.replaces for m in merged if _overlap(r.covers, m.covers)):
            merged = [m for m in merged if m.name not in r.replaces] + [r]
    return merged + [r for r in records if r.query is not None and not any(m.has(r.query, r.number) for m in merged)]


def _overlap(a: dict, b: dict) -> bool:
    return any(x[0] <= y[1] and y[0] <= x[1] for q in a if q in b for x in a[q] for y in b[q])

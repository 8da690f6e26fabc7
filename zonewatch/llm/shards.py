"""Sorted 64-bit keys with numbers, counted in Spark, kept as files and memory-mapped by workers.

Keys are dealt to ``n`` buckets by their leading bits, so sorted keys are grouped by bucket. A bucket is
merged by one task and becomes one file: the keys, then each column. Workers map the files they
need; mapped pages belong to the page cache and are shared by all workers of a machine, so a worker's own
memory does not grow with the table. The driver knows the files' names only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.llm.shared import new_folder, opened


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(n)) >> np.uint64(16)


def bounds(sorted_keys: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket begins, and the end."""
    return np.searchsorted(bucket_of(sorted_keys, n), np.arange(n + 1, dtype=np.uint64))


def six(keys: np.ndarray) -> bytes:
    """The upper 48 bits of each key, six bytes a key."""
    return np.ascontiguousarray((keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unsix(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel() << np.uint64(16)


def counted(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[at], np.diff(np.append(at, len(sorted_keys)))


def summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each column."""
    if not len(keys):
        return keys, *columns
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], *(np.add.reduceat(c[order], at) for c in columns)


def buckets(spark: SparkSession) -> int:
    """As many buckets as the session's shuffles have partitions (at most the 65,536 that the leading bits tell apart)."""
    return max(1, min(1 << 16, int(spark.conf.get("spark.sql.shuffle.partitions"))))


class Shards:
    """The files of one table. ``kinds`` are the columns' types."""

    def __init__(self, n: int, kinds: tuple[str, ...], files: dict[int, tuple[str, int]]):
        self.n, self.kinds, self.files = n, kinds, files
        self.open: dict[int, tuple[np.ndarray, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "open": {}}

    def shard(self, bucket: int) -> tuple[np.ndarray, ...] | None:
        if bucket not in self.open and bucket in self.files:
            uri, size = self.files[bucket]
            store, path = opened(uri)
            if uri.startswith("file:"):
                data = np.memmap(path, np.uint8, "r")
            else:  # a store that cannot be mapped
                with store.open_input_stream(path) as stream:
                    data = np.frombuffer(stream.read(), np.uint8)
            parts, at = [], 0
            for kind in ("<u8", *self.kinds):
                to = at + size * np.dtype(kind).itemsize
                parts.append(data[at:to].view(kind))
                at = to
            self.open[bucket] = tuple(parts)
        return self.open.get(bucket)

    def find(self, sorted_keys: np.ndarray) -> list[np.ndarray]:
        """The columns at ascending keys, 0 where a key is missing."""
        out = [np.zeros(len(sorted_keys), kind) for kind in self.kinds]
        cuts = bounds(sorted_keys, self.n)
        for b in np.flatnonzero(np.diff(cuts)):
            shard = self.shard(int(b))
            if shard is None or not len(shard[0]):
                continue
            asked = sorted_keys[cuts[b] : cuts[b + 1]]
            place = np.minimum(np.searchsorted(shard[0], asked), len(shard[0]) - 1)
            hit = np.flatnonzero(shard[0][place] == asked)
            for column, values in zip(out, shard[1:], strict=True):
                column[cuts[b] + hit] = values[place[hit]]
        return out

    def find_any(self, keys: np.ndarray) -> list[np.ndarray]:
        """As ``find``, for keys in any order."""
        known, back = np.unique(keys, return_inverse=True)
        return [c[back] for c in self.find(known)]


def save(folder: str, bucket: int, arrays: list[np.ndarray]) -> str:
    """Writes one bucket under a name of this attempt, so that a repeated task disturbs nothing."""
    store, inside = opened(folder)
    name = f"{bucket:05d}-{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(f"{inside}/{name}") as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return f"{folder}/{name}"


def store(parts: DataFrame, merge, kinds: tuple[str, ...], n: int, extra: str = "") -> tuple[Shards, pa.Table]:
    """Merges the rows of each bucket and keeps the result. ``merge(table)`` returns the keys, the
    columns and a dictionary of numbers (``extra``: their names), which come back as a table with a
    row per bucket."""
    folder, names = new_folder(parts.sparkSession, "shards"), extra.split()

    def run(key, table):
        keys, columns, numbers = merge(table)
        bucket = key[0].as_py()
        path = save(folder, bucket, [keys.astype("<u8"), *(c.astype(k) for c, k in zip(columns, kinds, strict=True))])
        found = {"bucket": pa.array([bucket], pa.int32()), "path": pa.array([path]), "n": pa.array([len(keys)], pa.int64())}
        return pa.table(found | {x: pa.array([float(numbers[x])]) for x in names})

    schema = "bucket int, path string, n long" + "".join(f", {x} double" for x in names)
    made = parts.groupBy("bucket").applyInArrow(run, schema).toArrow()
    rows = zip(*(made[c].to_pylist() for c in ("bucket", "path", "n")), strict=True)
    return Shards(n, kinds, {b: (path, size) for b, path, size in rows if size}), made


def kept(rows: DataFrame, kinds: tuple[str, ...], n: int) -> Shards:
    """Distinct ``key`` longs, read as unsigned, and a column of each kind behind them, as ``n`` files."""
    columns = [c for c in rows.columns if c != "key"]
    bucket = F.expr(f"cast(shiftrightunsigned(shiftrightunsigned(key, 48) * {n}L, 16) AS int)")

    def merge(table):
        keys = table["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return keys[order], [table[c].to_numpy()[order] for c in columns], {}

    return store(rows.withColumn("bucket", bucket), merge, kinds, n)[0]


def enough(spark: SparkSession, rows: int, each: int = 500_000) -> int:
    """Buckets of about ``each`` rows, as many as the shuffles have partitions at least."""
    return max(buckets(spark), min(1 << 16, -(-rows // each)))

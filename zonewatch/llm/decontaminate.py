"""Benchmark decontamination: documents whose words repeat windows of test items.

Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A window is ``size``
consecutive words of an item; an item with fewer words, but not none, is one window. Every window
of every document is looked up in a hash set of the items' windows, and a hit counts only after its
words have been compared. All words inside an occurrence are hit.

The items' windows are broadcast in parts of at most ``PART_BYTES`` of item text, so that no broadcast
grows with the benchmark; a larger benchmark takes more passes, whose hits are merged per document.

Defined cases: a null or empty text has no words and stays clean; null or repeated item ids are allowed
(a null id is never listed, its windows still hit); an empty benchmark hits nothing; repeated documents
give a row each; other columns are ignored by ``scan`` and kept by ``clean``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays
from zonewatch.llm.shared import written

SIZE = 10
PART_BYTES = 32 << 20
PAIRS = pa.list_(pa.list_(pa.int64()))


class Windows:
    """Windows of some items by length: sorted hashes, their words, and the items that hold them."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        column = pa.array([t for _, t in items], pa.string())
        words = arrays.as_texts(column).words()
        found: dict[int, dict[int, dict[bytes, set]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        counts = words.counts()
        for n in {min(int(c), size) for c in counts if c}:
            at, hashes = words.windows(n)
            rows = words.rows()[at]
            for a, h, r in zip(at, hashes, rows, strict=True):
                if min(int(counts[r]), size) == n:
                    found[n][int(h)][words.text(a, n)].add(items[r][0])
        self.by_size = {n: (np.array(sorted(by), np.uint64), {h: {t: sorted(i for i in ids if i is not None) for t, ids in ts.items()} for h, ts in by.items()}) for n, by in found.items()}

    def hits(self, words: arrays.Words):
        """(first word, length, item ids) of every verified occurrence."""
        for n, (known, texts) in self.by_size.items():
            at, hashes = words.windows(n)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for k in np.flatnonzero(known[place] == hashes):
                ids = texts[int(hashes[k])].get(words.text(at[k], n))
                if ids is not None:
                    yield int(at[k]), n, ids


def parts(benchmark: DataFrame, size: int, part_bytes: int, item_id: str, text: str) -> Iterator[Windows]:
    """The items' windows, each part from at most ``part_bytes`` of text (or one item)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    held, bytes_held = [], 0
    for row in items.toLocalIterator():
        if held and bytes_held + len(row.text) > part_bytes:
            yield Windows(held, size)
            held, bytes_held = [], 0
        held.append((row.id, row.text))
        bytes_held += len(row.text)
    yield Windows(held, size)


def passes(df: DataFrame, found: Iterator[Windows], one: Callable[[DataFrame, Broadcast], DataFrame]) -> DataFrame:
    """``one`` pass per part. With more than one part the rows are written between passes, so that a
    worker holds a single part at a time."""
    windows = next(found)
    while (then := next(found, None)) is not None:
        df, windows = written(one(df, df.sparkSession.sparkContext.broadcast(windows)), "decontaminate"), then
    return one(df, df.sparkSession.sparkContext.broadcast(windows))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: its id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``,
    ``hit_words`` (runs of hit words as [first, end) pairs) and ``items``."""

    def one(df: DataFrame, windows: Broadcast) -> DataFrame:
        def run(batch, texts):
            words = texts.words()
            change, listed = np.zeros(len(words) + 1, np.int64), [set(x) for x in batch["items"].to_pylist()]
            for r, runs in enumerate(batch["hit_words"].to_pylist()):
                for a, b in runs:
                    change[words.bounds[r] + a] += 1
                    change[words.bounds[r] + b] -= 1
            for at, n, ids in windows.value.hits(words):
                change[at] += 1
                change[at + n] -= 1
                listed[int(np.searchsorted(words.bounds, at, side="right")) - 1].update(ids)
            hit = np.cumsum(change)[:-1] > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            some = total[words.bounds[1:]] > total[words.bounds[:-1]]
            runs = [_runs(hit[words.bounds[r] : words.bounds[r + 1]]) if some[r] else [] for r in range(len(texts))]
            new = {"n_words": pa.array(words.counts().astype(np.int64)), "hit_words": pa.array(runs, PAIRS), "items": pa.array([sorted(x) for x in listed], pa.list_(pa.string()))}
            return arrays.batch(**{c: new.get(c, batch[c]) for c in batch.schema.names})

        return arrays.map_texts(df, run, df.schema)

    empty = "cast(0 AS long) AS n_words", "cast(array() AS array<array<long>>) AS hit_words", "cast(array() AS array<string>) AS items"
    start = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).selectExpr("doc_id", "text", *empty)
    found = passes(start, parts(benchmark, size, part_bytes, item_id, item_text), one)
    return found.selectExpr(
        "doc_id",
        "n_words",
        "aggregate(hit_words, 0L, (n, r) -> n + r[1] - r[0]) AS n_hit",
        "cast(size(items) AS long) AS n_items",
        "sha2(concat_ws(',', items), 256) AS items_sha256",
        "size(hit_words) > 0 AS contaminated",
        "hit_words",
        "items",
    )


def _runs(hit: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text: str = "text", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents without contaminated ones, all columns kept. No join: each row is judged in its place."""

    def one(df: DataFrame, windows: Broadcast) -> DataFrame:
        def run(batch, texts):
            words = texts.words()
            keep = np.ones(len(texts), bool)
            for at, _, _ in windows.value.hits(words):
                keep[int(np.searchsorted(words.bounds, at, side="right")) - 1] = False
            return batch.filter(pa.array(keep))

        return arrays.map_texts(df, run, df.schema, text)

    items = benchmark.select(F.lit(None).cast("string").alias("id"), F.col(item_text).alias("text"))
    return passes(docs, parts(items, size, part_bytes, "id", "text"), one)

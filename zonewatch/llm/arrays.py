"""Texts of Arrow batches as byte arrays: blocks, words and their hashes.

Words are found on UTF-8 bytes. Every byte of a character beyond ASCII is 0x80 or more, so a word
class that takes in all such characters is a class of bytes, and no text is decoded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at once, unless one row alone has more.
BLOCK_BYTES = 2 << 20
#: Bytes whose words are hashed at once.
HASHED_BYTES = 1 << 19

#: Odd multipliers of the two rolling hashes (bytes into words, words into windows).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, a-z and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

#: [^\x20\x09-\x0D]
SPACED = np.ones(256, bool)
SPACED[0x20] = SPACED[0x09:0x0E] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.size = base, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n + n // 8, 1 << 16)  # both arrays stay with the worker: no doubling
            self.up, self.down = (_powers(b, self.size) for b in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@cache
def powers(base: int) -> Powers:
    return Powers(base)


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base).upto(max(1, len(values)))
    out = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, up[: len(values)], out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for many ranges at once; equal ranges have equal hashes."""
    _, down = powers(base).upto(max(1, len(sums)))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(WORD_BASE))


class Texts:
    """Rows of a string column as one byte array; row i is data[bounds[i]:bounds[i + 1]]. Null is empty."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, kind: np.ndarray = WORD, lower: bool = True) -> Words:
        return Words(LOWER[self.data] if lower else self.data, self.bounds, kind)


class Words:
    """Words of a block of texts: byte ranges, 64-bit hashes, and the first word of each row."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, kind: np.ndarray):
        inside = kind[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            cuts = bounds[(bounds > 0) & (bounds < len(data))]  # a word ends where its row ends
            first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
        self.data = data
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, bounds)
        self.hash = np.empty(len(self.start), np.uint64)
        # some rows at a time: their sums stay in the cache
        row = 0
        while row < len(bounds) - 1:
            to = max(row + 1, int(np.searchsorted(bounds, bounds[row] + HASHED_BYTES, side="right")) - 1)
            a, b, base = self.bounds[row], self.bounds[to], bounds[row]
            self.hash[a:b] = range_hashes(prefix_sums(data[base : bounds[to]], BYTE_BASE), self.start[a:b] - base, self.end[a:b] - base, BYTE_BASE)
            row = to

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words that stays in one row."""
        ends = np.repeat(self.bounds[1:], self.counts())
        at = np.flatnonzero(np.arange(len(self)) + size <= ends)
        return at, range_hashes(prefix_sums(self.hash, WORD_BASE), at, at + size, WORD_BASE)

    def text(self, first: int, size: int = 1) -> bytes:
        """``size`` words from ``first``, joined by blanks."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[first : first + size], self.end[first : first + size], strict=True))


def as_texts(column: pa.Array) -> Texts:
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def blocks(batches: Iterable[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of whole rows with about ``size`` bytes of text."""
    for batch in batches:
        bounds, at = as_texts(batch[text]).bounds, 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
            part = batch.slice(at, to - at)
            yield part, as_texts(part[text])
            at = to


def released() -> None:
    """Gives memory back, also that of the powers: a worker lives on after its task, beside the workers of the next stage."""
    powers.cache_clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch, Texts], pa.RecordBatch | None], schema: str, text: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """``fn`` on blocks of rows; it returns a batch in the order of ``schema``."""

    def run(batches):
        for batch, texts in blocks(batches, text, size):
            if (out := fn(batch, texts)) is not None and len(out):
                yield out
        released()

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())

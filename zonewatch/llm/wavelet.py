"""Token ids as wavelet matrices, a compressed file per shard.

Documents are dealt in ascending order of id (a range partition and a sort), encoded, and cut into shards of
about ``SHARD_TOKENS`` tokens at document bounds. A shard's file holds the documents' ids and token
bounds and, for every bit of the vocabulary, from the highest, a plane of bits in wavelet-matrix order with a count
of ones before every block of 512 bits. From that one file a reader gets any token, counts a token in
any prefix, finds its k-th occurrence, or unpacks all.

Words between ASCII white space are encoded once per block, and once per worker while they fit its cache of
``CACHE_WORDS``: no token of this kind of vocabulary crosses white space, so a text's ids are its words' ids
in order. That holds for tokenizers that drop white space; ``whole=True`` encodes each text as it is.

Shard files carry the name of their task's attempt, and the table of shards, written by Spark, names the files of the
committed attempts.

Defined cases: a null or empty text has the end id alone; null ids come first; equal ids are ordered by a hash of their text;
repeated rows give a row each; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewatch.llm import arrays
from zonewatch.llm.shared import new_folder, opened, written

SHARD_TOKENS = 4 << 20
CACHE_WORDS = 1_500_000
BLOCK_BYTES = 8 << 20
MAGIC, RANK = b"WAVELET1", 512
END_ID = 2


class WaveletMatrix:
    """Bit planes of a sequence of ids, with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def of(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, zeros, ranks = [], [], []
        for level in reversed(range(levels)):
            bits = (ids >> ids.dtype.type(level)) & ids.dtype.type(1) != 0
            low, high = ids[~bits], ids[bits]
            packed = np.packbits(bits, bitorder="little")
            padded = np.zeros(-(-len(packed) // 64) * 64, np.uint8)
            padded[: len(packed)] = packed
            per = np.bitwise_count(padded.view("<u8")).reshape(-1, 8).sum(axis=1)
            ranks.append(np.concatenate([[0], np.cumsum(per)]).astype("<u4"))
            planes.append(padded)
            zeros.append(len(low))
            ids = np.concatenate([low, high])
        return cls(len(ids), planes, zeros, ranks)

    def _ones(self, level: int, at: int) -> int:
        """Ones before ``at``."""
        block = at // RANK
        count, start = int(self.ranks[level][block]), block * 64
        whole, rest = at // 8, at % 8
        count += int(np.bitwise_count(self.planes[level][start:whole]).sum())
        return count + (int(self.planes[level][whole]) & ((1 << rest) - 1)).bit_count() if rest else count

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at // 8]) >> (at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        out = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones(level, at)
            out = out * 2 + bit
            at = self.zeros[level] + ones if bit else at - ones
        return out

    def _span(self, token: int, at: int) -> tuple[int, int]:
        """Where the occurrences of a token begin in the last order, and how far those before ``at`` go."""
        start, levels = 0, len(self.planes)
        if token >> levels:
            return 0, 0
        for level in range(levels):
            a, b = self._ones(level, start), self._ones(level, at)
            if token >> (levels - 1 - level) & 1:
                start, at = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, at = start - a, at - b
        return start, at

    def count(self, token: int, at: int | None = None) -> int:
        """Occurrences of a token before ``at``."""
        start, end = self._span(token, self.n if at is None else at)
        return end - start

    def _select(self, level: int, bit: int, k: int) -> int:
        """The position of the k-th (from 0) bit of this kind in a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * RANK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * 64 : block * 64 + 64], bitorder="little")
        return block * RANK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of a token."""
        start, end = self._span(token, self.n)
        if not 0 <= k < end - start:
            raise IndexError(f"token {token} occurs {end - start} times")
        at, levels = start + k, len(self.planes)
        for level in reversed(range(levels)):
            bit = token >> (levels - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def unpack(self) -> np.ndarray:
        """All ids. The planes are taken back from the last one, each in one sweep."""
        ids = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in reversed(range(len(self.planes))):
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before, zeros = np.empty_like(ids), self.zeros[level]
            before[~bits] = ids[:zeros]
            before[bits] = ids[zeros:] | ids.dtype.type(1 << (len(self.planes) - 1 - level))
            ids = before
        return ids

    def tobytes(self) -> Iterator[bytes]:
        yield struct.pack("<QI", self.n, len(self.planes))
        yield np.array(self.zeros, "<u8").tobytes()
        for plane, ranks in zip(self.planes, self.ranks, strict=True):
            yield plane.tobytes()
            yield ranks.tobytes()

    @classmethod
    def frombytes(cls, data: np.ndarray) -> WaveletMatrix:
        n, levels = struct.unpack("<QI", data[:12].tobytes())
        zeros, at = data[12 : 12 + 8 * levels].view("<u8").tolist(), 12 + 8 * levels
        planes, ranks, blocks = [], [], -(-n // RANK)
        for _ in range(levels):
            planes.append(data[at : at + 64 * blocks])
            at += 64 * blocks
            ranks.append(data[at : at + 4 * (blocks + 1)].copy().view("<u4"))
            at += 4 * (blocks + 1)
        return cls(n, planes, zeros, ranks)


def shard_bytes(ids: list[int | None], bounds: np.ndarray, matrix: WaveletMatrix) -> Iterator[bytes]:
    """A file: magic, documents, whether each has an id, ids, token bounds, matrix."""
    yield MAGIC + struct.pack("<Q", len(ids))
    yield np.array([i is not None for i in ids], np.uint8).tobytes()
    yield np.array([i or 0 for i in ids], "<i8").tobytes()
    yield np.asarray(bounds, "<u8").tobytes()
    yield from matrix.tobytes()


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    if data[:8] != MAGIC:
        raise ValueError("not a shard")
    (n,) = struct.unpack("<Q", data[8:16])
    raw = np.frombuffer(data, np.uint8)
    has, at = raw[16 : 16 + n].astype(bool), 16 + n
    ids = raw[at : at + 8 * n].copy().view("<i8")
    bounds = raw[at + 8 * n : at + 16 * n + 8].copy().view("<u8").astype(np.int64)
    return [i if ok else None for i, ok in zip(ids.tolist(), has.tolist(), strict=True)], bounds, WaveletMatrix.frombytes(raw[at + 16 * n + 8 :].copy())


class Encoder:
    """Ids of the rows of a block. Distinct words are encoded once; words of earlier blocks are kept."""

    def __init__(self, path: str, whole: bool, cache_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core; threads of the library only cost
        from tokenizers import Tokenizer

        self.tokenizer, self.whole, self.cache_words = Tokenizer.from_file(path), whole, cache_words
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.forget()

    def forget(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        ids, sizes = [], np.zeros(len(words), np.int64)
        for at in range(0, len(words), 2000):  # each by itself: the library's fast way tells no token's word
            parts = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words[at : at + 2000]]
            ids.append(np.array([i for p in parts for i in p], np.uint32))
            sizes[at : at + 2000] = [len(p) for p in parts]
        return np.concatenate(ids or [np.zeros(0, np.uint32)]), sizes

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > self.cache_words:
            self.forget()
        ids, size = self.words(words)
        start = np.cumsum(size) - size + len(self.flat)
        self.flat = np.concatenate([self.flat, ids])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = (np.insert(old, place, new) for old, new in ((self.keys, keys), (self.start, start), (self.size, size)))

    def block(self, texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the number of each row's."""
        if self.whole:
            rows = [r.ids for r in self.tokenizer.encode_batch([texts.data[a:b].tobytes().decode() for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)], add_special_tokens=False)]
            return np.array([i for r in rows for i in r], np.uint32), np.array([len(r) for r in rows], np.int64)
        words = texts.words(arrays.SPACED, lower=False)
        keys, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        known = self._known(keys)
        if len(new := np.flatnonzero(~known)):
            if len(self.keys) + len(new) > self.cache_words:  # the block's other words go with the cache
                self.forget()
                new = np.arange(len(keys))
            raw = words.data.tobytes()
            at = first[new]
            self.learn(keys[new], [raw[s:e].decode() for s, e in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)])
        place = np.searchsorted(self.keys, keys)
        size = self.size[place][back]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[place][back] - total[:-1], size) + np.arange(total[-1])
        return self.flat[at], total[words.bounds[1:]] - total[words.bounds[:-1]]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, whole: bool, cache_words: int) -> Encoder:
    """A worker keeps its encoder over tasks."""
    key = (path, whole, cache_words)
    if key not in ENCODERS:
        ENCODERS[key] = Encoder(*key)
    return ENCODERS[key]


SHARDS = "partition int, shard int, path string, documents long, tokens long"


def write(docs: DataFrame, tokenizer: Callable[[], str], doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, whole: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Writes the shards; returns their table with ``start``, the tokens before each shard. ``tokenizer`` gives
    the vocabulary file's path where it is called."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    folder = new_folder(docs.sparkSession, "tokens")

    def run(batches):
        task = TaskContext.get()
        own, (store, inside) = encoder(tokenizer(), whole, cache_words), opened(folder)
        levels = max(1, int(max(own.vocabulary - 1, end_id)).bit_length())
        kind = np.uint32 if levels > 16 else np.uint16
        held, ids, sizes, count, shard = [], [], [], 0, 0

        def closed():
            name = f"{folder}/{task.partitionId():05d}-{task.taskAttemptId()}-{shard:05d}.wm"
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            matrix = WaveletMatrix.of(np.concatenate(held), levels)
            with store.open_output_stream(f"{inside}/{name.rsplit('/', 1)[1]}") as out:
                for part in shard_bytes(ids, bounds, matrix):
                    out.write(part)
            return arrays.batch(partition=pa.array([task.partitionId()], pa.int32()), shard=pa.array([shard], pa.int32()), path=[name], documents=[len(ids)], tokens=[int(bounds[-1])])

        for batch, texts in arrays.blocks(batches, "text", BLOCK_BYTES):
            found, n = own.block(texts)
            out = np.insert(found.astype(kind), np.cumsum(n), kind(end_id))
            held.append(out)
            sizes.append(n + 1)
            ids += batch["doc_id"].to_pylist()
            count += len(out)
            if count >= shard_tokens:
                yield closed()
                held, ids, sizes, count, shard = [], [], [], 0, shard + 1
        if ids:
            yield closed()

    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # many rows may share one id (or have none): a hash of their text parts them, also over partitions
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    dealt = rows.repartitionByRange(width, *order).sortWithinPartitions(*order).drop("tie")
    table = written(dealt.mapInArrow(run, SHARDS), "token-shards")
    # tokens before each partition (the driver sees a number for each), then before each shard in it
    per = sorted(map(tuple, table.groupBy("partition").agg(F.sum("tokens")).collect()))
    before, total = [], 0
    for p, n in per:
        before.append((p, total))
        total += n
    offsets = docs.sparkSession.createDataFrame(before, "partition int, before long")
    within = F.sum("tokens").over(Window.partitionBy("partition").orderBy("shard")) - F.col("tokens")
    return table.join(offsets, "partition").withColumn("start", F.col("before") + within).drop("before")


def read(table: DataFrame) -> DataFrame:
    """Per document of the shards: doc_id, start, n_tokens, ids_crc32, in no order."""

    def run(batches):
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                store, inside = opened(path)
                with store.open_input_stream(inside) as stream:
                    ids, bounds, matrix = open_shard(stream.read())
                raw = memoryview(matrix.unpack().astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield arrays.batch(doc_id=pa.array(ids, pa.int64()), start=start + bounds[:-1], n_tokens=np.diff(bounds), ids_crc32=pa.array(crc, pa.int64()))

    parallel = table.sparkSession.sparkContext.defaultParallelism * 4
    return table.select("path", "start").repartition(parallel, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

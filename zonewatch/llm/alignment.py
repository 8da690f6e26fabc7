"""Which tokens of two tokenizers stand for the same bytes, in every document and over the whole corpus.

A is a byte-level BPE that encodes a blank and the text, B a SentencePiece model that adds the blank by itself. Over the
bytes of a text each gives an incidence matrix (tokens by bytes, a one where a token covers a byte), kept in compressed
rows. Row products after Gustavson multiply them: A times B transposed has an entry for each pair of tokens that overlap, the
number of bytes they share. Places where tokens of both end cut the bytes into groups; A's incidence with the groups
times that of B transposed has an entry for each pair in one group, a link.

1. Texts are cut where no token of either can cross, before a blank that follows a letter, sign or digit; equal parts of a block
   are encoded and multiplied once. Documents with a part whose bytes do not come back are encoded again as
   one part; if they still do not, they have no tokens.
2. Each row is written with its linked id pairs and how often each is linked.
3. Tasks count in how many documents a pair is linked, per block and task before the shuffle. The highest count of each A
   id has a row per id of the vocabulary, which bounds its broadcast. Counts are kept in sorted files
   that workers map, and added up per row.

Defined cases: texts that are null, empty or do not come back have no tokens, zeros and an empty ``groups_sha256``;
repeated rows are documents of their own, also those with a null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays, shards
from zonewatch.llm.shared import written
from zonewatch.llm.suffix_groups import ragged, runs

#: Bytes of parts that are encoded in one call, and of text aligned at once.
CALL, BLOCK = 1 << 13, 2 << 20
#: Entries of a product that are expanded at once.
ENTRIES = 4 << 20
#: Pairs that a task adds up before it sends them on.
CHUNK = 4 << 20
BLANK = "▁"


class Rows:
    """A matrix of small counts in compressed rows."""

    def __init__(self, start: np.ndarray, column: np.ndarray, value: np.ndarray, width: int):
        self.start, self.column, self.value, self.width = start, column, value, width

    @classmethod
    def ones(cls, row: np.ndarray, column: np.ndarray, height: int, width: int) -> Rows:
        """A one at each (row, column); rows ascending."""
        return cls(np.searchsorted(row, np.arange(height + 1)), column, np.ones(len(row), np.int64), width)

    def height(self) -> int:
        return len(self.start) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height()), np.diff(self.start))

    def times(self, other: Rows) -> Rows:
        """The product, row by row: a row is the sum of the rows of ``other`` that its entries name."""
        size = np.diff(other.start)[self.column]
        total = np.concatenate([[0], np.cumsum(size)])[self.start]
        row, parts, at = self.rows(), [], 0
        while at < self.height():
            to = max(at + 1, int(np.searchsorted(total, total[at] + ENTRIES, side="right")) - 1)
            part = slice(self.start[at], self.start[to])
            place = ragged(other.start[self.column[part]], size[part])
            key = np.repeat(row[part], size[part]) * other.width + other.column[place]
            value = np.repeat(self.value[part], size[part]) * other.value[place]
            parts.append(shards.summed(key, value))
            at = to
        key, value = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
        return Rows(np.searchsorted(key, np.arange(self.height() + 1) * other.width), key % max(1, other.width), value, other.width)


class Tokens:
    """Tokens of all parts: part, id, end in the parts' joined bytes."""

    def __init__(self, part: np.ndarray, ids: np.ndarray, end: np.ndarray):
        self.part, self.ids, self.end = part, ids, end

    def __len__(self) -> int:
        return len(self.ids)

    def by_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """(token, byte) of the incidence."""
        size = np.diff(self.end, prepend=0)
        return np.repeat(np.arange(len(self)), size), np.arange(size.sum())


class Pair:
    """The two tokenizers, with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the bytes that byte-level vocabularies write as themselves
        letters = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = {i: bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)}
        self.sizes = [np.array([len(x.get(i, b"")) for i in range(max(x) + 1)]) for x in (self.a_bytes, self.b_bytes)]
        #: No piece goes on with a blank, so a text may be cut before one.
        self.may_cut = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)

    def encoded(self, part: bytes) -> tuple[list[int], list[int], bool]:
        """Ids of a part, which begins with a blank, and whether both give its bytes back."""
        text = part.decode()
        (a,) = self.a.encode_batch_fast([text], add_special_tokens=False)  # no offsets
        a, b = a.ids, self.b.encode(text[1:], num_threads=1)
        return a, b, part == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))

    def tokens(self, parts: list[bytes]) -> tuple[Tokens, Tokens, np.ndarray]:
        """The tokens of all parts that come back, and which do."""
        found, good = ([], []), np.ones(len(parts), bool)
        at = 0
        while at < len(parts):
            to, size = at, 0
            while to < len(parts) and size < CALL:
                size += len(parts[to])
                to += 1
                if not _ends_word(parts[to - 1]):
                    break
            a, b, same = self.encoded(b"".join(parts[at:to]))
            ends = np.cumsum([len(p) for p in parts[at:to]])
            ids = [np.array(x, np.int64) for x in (a, b)]
            to_end = [np.cumsum(self.sizes[k][x]) for k, x in enumerate(ids)] if same else []
            number = [np.searchsorted(ends, x) for x in to_end]
            if same and all((x[np.searchsorted(x, ends)] == ends).all() for x in to_end):
                for k in (0, 1):
                    found[k].append((at + number[k], ids[k]))
            else:
                for j in range(at, to):
                    a, b, good[j] = self.encoded(parts[j]) if to > at + 1 else (a, b, False)
                    for k, ids in enumerate((a, b) if good[j] else ([], [])):
                        found[k].append((np.full(len(ids), j), np.array(ids, np.int64)))
            at = to
        out = []
        for k, some in enumerate(found):
            part, ids = (np.concatenate([s[x] for s in some]) if some else np.zeros(0, np.int64) for x in (0, 1))
            out.append(Tokens(part, ids, np.cumsum(self.sizes[k][ids])))
        return out[0], out[1], good


@cache
def loaded(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _ends_word(part: bytes) -> bool:
    return 0x21 <= part[-1] <= 0x7E or len(part) > 2 and part[-1] >= 0x80 and 0xC3 <= part[-2] <= 0xDF


def cuts(data: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where parts begin: at each row (``bounds``, none empty) and, but for ``whole`` rows, before the blanks at which no token goes on.
    A character of two bytes ends a word like a sign if it is no white space (those begin with 0xC2)."""
    blank = data == 0x20
    ends = (data >= 0x21) & (data <= 0x7E)
    ends[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    start = np.zeros(len(data), bool)
    start[1:] = blank[1:] & ends[:-1]
    start[bounds[1:] - 1] = False  # a blank alone is no text for B
    start &= ~np.repeat(whole, np.diff(bounds))
    start[bounds[:-1]] = True
    return np.flatnonzero(start)


class Aligned:
    """Groups, links and overlaps of parts."""

    def __init__(self, a: Tokens, b: Tokens, parts: int):
        size = int(a.end[-1]) if len(a) else 0
        ends = np.zeros((2, size + 1), bool)
        ends[0, a.end], ends[1, b.end] = True, True
        both = ends[0] & ends[1]
        shared, upto = np.flatnonzero(both), np.cumsum(both)  # the groups' ends
        groups = [upto[x.end] - both[x.end] for x in (a, b)]
        (row, byte), (own, under) = a.by_bytes(), b.by_bytes()
        overlap = Rows.ones(row, byte, len(a), size).times(Rows.ones(under, own, size, len(b)))
        link = Rows.ones(np.arange(len(a)), groups[0], len(a), len(shared)).times(Rows.ones(groups[1], np.arange(len(b)), len(shared), len(b)))
        rows = link.rows()

        def count(of: np.ndarray) -> np.ndarray:
            return np.bincount(of, minlength=parts)

        self.counts = {"n_a": count(a.part), "n_b": count(b.part), "n_groups": count(a.part[np.searchsorted(a.end, shared)]), "n_links": count(a.part[rows]), "n_overlaps": count(a.part[overlap.rows()])}
        pair = (a.ids[rows] << 32) | b.ids[link.column]
        self.ids, number = np.unique(pair, return_inverse=True)
        key, times = shards.counted(np.sort(a.part[rows] * max(1, len(self.ids)) + number))
        #: Linked id pairs of each part, as places in ``ids``, and how often.
        self.pairs = Rows(np.searchsorted(key, np.arange(parts + 1) * max(1, len(self.ids))), key % max(1, len(self.ids)), times, len(self.ids))
        self.texts = _texts(a, b, groups, parts)


def _texts(a: Tokens, b: Tokens, groups: list[np.ndarray], parts: int) -> list[bytes]:
    """Each part's groups as `a1,a2|b1;a3|b2,b3`."""
    ids, part, group = np.concatenate([a.ids, b.ids]), np.concatenate([a.part, b.part]), np.concatenate(groups)
    if not len(ids):
        return [b""] * parts
    side = np.repeat([0, 1], [len(a), len(b)])
    order = np.argsort(2 * group + side, kind="stable")  # tokens stay in order
    ids, part, group, side = ids[order], part[order], group[order], side[order]
    numbers, start = digits(int(ids.max()) + 1)
    size = np.diff(start)[ids]
    at = np.cumsum(size + 1) - (size + 1)
    out = np.empty(at[-1] + size[-1] + 1, np.uint8)
    out[ragged(at, size)] = numbers[ragged(start[ids], size)]
    after = np.full(len(ids), ord(","), np.uint8)
    after[:-1][side[1:] != side[:-1]] = ord("|")
    after[:-1][group[1:] != group[:-1]] = ord(";")
    out[at + size] = after
    bounds = np.append(at, len(out))[np.searchsorted(part, np.arange(parts + 1))].tolist()
    text = out.tobytes()
    return [text[x : max(x, y - 1)] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


@cache
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    shown = [str(i).encode() for i in range(n)]
    return np.frombuffer(b"".join(shown), np.uint8), np.cumsum([0, *map(len, shown)])


def digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below some power of two from ``n`` on, and where each begins."""
    return _digits(1 << max(16, (n - 1).bit_length()))


SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, path_a: Callable[[], str], path_b: Callable[[], str]) -> DataFrame:
    """Per row its counts and, as 64-bit and 32-bit numbers, its linked pairs (A id, B id) and how often each is linked."""

    def run(batch, texts):
        pair = loaded(path_a(), path_b())
        full = np.flatnonzero(np.diff(texts.bounds) > 0)
        size = np.diff(texts.bounds)[full] + 1
        bounds = np.concatenate([[0], np.cumsum(size)])
        data = np.full(bounds[-1], 0x20, np.uint8)
        data[ragged(bounds[:-1] + 1, size - 1)] = texts.data
        joined, whole = data.tobytes(), np.full(len(full), not pair.may_cut)
        for _ in range(2):
            start = cuts(data, bounds, whole)
            end = np.append(start[1:], len(data))
            keys = arrays.range_hashes(arrays.prefix_sums(data, arrays.BYTE_BASE), start, end, arrays.BYTE_BASE)
            _, first, unit = np.unique(keys, return_index=True, return_inverse=True)
            a, b, good = pair.tokens([joined[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)])
            at = np.searchsorted(start, bounds)
            bad = np.add.reduceat(~good[unit], at[:-1]) > 0 if len(full) else np.zeros(0, bool)
            if not (bad & ~whole).any():
                break
            whole = whole | bad
        found = Aligned(a, b, len(first))
        row = np.repeat(np.arange(len(full)), np.diff(at))
        columns = {c: np.zeros(len(texts), np.int64) for c in found.counts}
        for c, n in found.counts.items():
            columns[c][full] = np.bincount(row, weights=n[unit], minlength=len(full)).astype(np.int64) * ~bad
        # rows by parts times parts by pairs
        key, n = shards.counted(np.sort(row * max(1, len(first)) + unit))
        pairs = Rows(np.searchsorted(key, np.arange(len(full) + 1) * max(1, len(first))), key % max(1, len(first)), n, len(first)).times(found.pairs)
        shas, blobs, times = [""] * len(texts), [b""] * len(texts), [b""] * len(texts)
        units = unit.tolist()
        for k, r in enumerate(full.tolist()):
            if not bad[k]:
                s = slice(pairs.start[k], pairs.start[k + 1])
                shas[r] = hashlib.sha256(b";".join([found.texts[u] for u in units[at[k] : at[k + 1]]])).hexdigest()
                blobs[r], times[r] = found.ids[pairs.column[s]].astype("<u8").tobytes(), pairs.value[s].astype("<u4").tobytes()
        return arrays.batch(doc_id=batch["doc_id"], **columns, groups_sha256=arrays.strings(shas), pairs=pa.array(blobs, pa.binary()), times=pa.array(times, pa.binary()))

    return arrays.map_texts(docs, run, SCHEMA, size=BLOCK)


def counted(rows: DataFrame) -> DataFrame:
    """(key, a, n): in how many rows a pair is linked; the key spreads the pair's bits."""

    def run(batches):
        held, waiting = [], 0

        def sent():
            pair, n = shards.summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            for at in range(0, len(pair), 1 << 16):
                part = pair[at : at + (1 << 16)]
                yield arrays.batch(key=pa.array(arrays.mixed(part).view(np.int64)), a=pa.array((part >> np.uint64(32)).astype(np.int64)), n=pa.array(n[at : at + (1 << 16)]))

        for batch in batches:
            for x in range(0, len(batch), 256):
                held.append(shards.counted(np.sort(np.frombuffer(b"".join(batch["pairs"][x : x + 256].to_pylist()), "<u8").astype(np.uint64))))
                waiting += len(held[-1][0])
                if waiting >= CHUNK:
                    held = [shards.summed(*(np.concatenate(y) for y in zip(*held, strict=True)))]
                    waiting = 0
                    if len(held[0][0]) >= CHUNK:
                        yield from sent()
                        held = []
        if held:
            yield from sent()
        arrays.released()

    return rows.select("pairs").mapInArrow(run, "key long, a long, n long").groupBy("key", "a").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, path_a: Callable[[], str], path_b: Callable[[], str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps, and its linked ``pairs`` and
    ``times`` as little-endian numbers (A id << 32 | B id)."""
    spark = docs.sparkSession
    rows = written(aligned(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), path_a, path_b), "aligned")
    counts = written(counted(rows), "link-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # a row per id of A's vocabulary at most
    marked = counts.join(F.broadcast(highest), "a").selectExpr("key", "n", "cast(n = highest AS int) AS best")
    table = shards.kept(marked, ("<i8", "u1"), shards.enough(spark, counts.count()))
    shared = spark.sparkContext.broadcast(table)
    schema = f"{SCHEMA}, n_best long, count_sum long"

    def run(batches):
        for batch in batches:
            for x in range(0, len(batch), 256):
                part = batch.slice(x, 256)
                size = np.array([len(t) // 4 for t in part["times"].to_pylist()], np.int64)
                pair = np.frombuffer(b"".join(part["pairs"].to_pylist()), "<u8").astype(np.uint64)
                times = np.frombuffer(b"".join(part["times"].to_pylist()), "<u4").astype(np.int64)
                n, best = shared.value.find_any(arrays.mixed(pair))
                bounds = np.concatenate([[0], np.cumsum(size)])
                sums = [np.diff(np.concatenate([[0], np.cumsum(times * y)])[bounds]) for y in (best.astype(np.int64), n)]
                yield arrays.batch(**{c: part[c] for c in part.schema.names}, n_best=pa.array(sums[0]), count_sum=pa.array(sums[1]))
        arrays.released()

    found = rows.mapInArrow(run, schema)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "pairs", "times")

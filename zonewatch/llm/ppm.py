"""Language identification by prediction by partial matching.

Every language has a byte context tree of orders 0 to ``ORDER`` with the counts of what followed each
context. A byte is coded in the longest context that the trees hold; a byte that a language never saw
there costs an escape (method C: distinct / (total + distinct)) and is coded in the next shorter context,
at last among 256 equal bytes. Code lengths are exact under these frozen statistics, and the language
with the shortest code wins. The score is its share when the code lengths are taken as likelihoods.

Learning takes a bounded sample: about ``SAMPLE`` documents per language (whole texts), chosen by a hash
of the id. Counting runs in Spark; the driver gets the counts of the sample alone. With ``least=1``, as the
registered queries ask, every context and every byte seen after it stays, of a rare language too; by default
pairs of context and byte seen once are left out. Prediction reads bytes alone: no id, source or label takes part.

The trees of ``GROUP`` languages share one trie of byte strings, so memory grows with the sample's strings and not
with their number times that of all languages. Where its steps take at most ``CELLS`` numbers over all groups they
are a table by string and byte, else a sorted array; both give the same.

Defined cases: a null text and a text without a letter give ``und`` and score 0; equal code lengths go to
the language that sorts first; with no language learned all is ``und``; repeated rows give a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays
from zonewatch.llm.shared import written

ORDER = 4
SAMPLE = 1500
GROUP = 8
CELLS = 1 << 24
UNKNOWN = "und"
#: Bytes scored at once: every byte takes some 50 bytes of numbers.
BLOCK_BYTES = 1 << 20
#: Languages up to this number are broadcast with their sizes.
LANGS = 100_000


class Trees:
    """The trees of some languages. A node is a byte string up to ``order + 1`` long, in its two roles: as a context
    and the byte after it, and as the context of the next byte. ``bits`` has the code length of the byte less the
    escapes of its context and all shorter ones, ``escapes`` those of the string as a context, a column per language:
    the longest known string and the longest known context give a byte's code length, whatever lies in between."""

    def __init__(self, keys: np.ndarray, lang: np.ndarray, n: np.ndarray, langs: int, order: int, cells: int):
        """keys: ``order * 2**56 + context and byte``, the context's last byte lowest but one."""
        self.order = order
        names, place = np.unique(keys, return_inverse=True)
        depth, packed = names >> 56, names & ((1 << 56) - 1)
        # 0: no node, 1: the empty string, then by length
        count, self.inner = len(names) + 2, 2 + int(np.searchsorted(depth, order))
        shift = 8 * np.maximum(depth, 1)
        shorter = (np.maximum(depth, 1) - 1) << 56
        parent, context = np.ones(count, np.int64), np.ones(count, np.int64)
        longer = depth > 0
        parent[2:][longer] = 2 + np.searchsorted(names, (shorter | (packed & ((1 << shift) - 1)))[longer])
        context[2:][longer] = 2 + np.searchsorted(names, (shorter | (packed >> 8))[longer])
        left = (packed >> (8 * depth)).astype(np.int64)
        self.classes = np.zeros(256, np.int32)  # class 0: bytes never seen
        seen = np.unique(packed & 255)
        self.classes[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        edge = parent[2:] * self.width + self.classes[left]
        self.next = self.edges = self.ends = None
        if self.inner * self.width <= cells:
            self.next = np.zeros(self.inner * self.width, np.int32)
            self.next[edge] = np.arange(2, count)
        else:
            by = np.argsort(edge)
            self.edges, self.ends = np.append(edge[by], np.iinfo(np.int64).max), np.append(by + 2, 0).astype(np.int32)
        self.bits, self.escapes = np.zeros((count, langs), np.float32), np.zeros((count, langs), np.float32)
        levels = [2 + np.flatnonzero(depth == d) for d in range(order + 1)]
        for i in range(langs):
            mine = lang == i
            at, times = 2 + place[mine], n[mine].astype(float)
            totals, distinct = np.bincount(context[at], weights=times, minlength=count), np.bincount(context[at], minlength=count)
            escape = np.where(distinct > 0, distinct / np.maximum(totals + distinct, 1), 1.0)
            share = np.zeros(count)
            share[at] = times / (totals + distinct)[context[at]]
            p, spent = np.full(count, 1 / 256), np.zeros(count)
            spent[1] = -np.log2(escape[1])
            # without exclusion: a shorter context also codes what the longer one knows
            for level in levels:
                p[level] = escape[context[level]] * p[parent[level]] + share[level]
                spent[level] = spent[parent[level]] - np.log2(escape[level])
            self.bits[:, i] = -np.log2(p) - np.where(np.arange(count) > 1, spent[context], 0)
            self.escapes[:, i] = spent

    def step(self, node: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The nodes of the strings that are one byte longer to the left; 0 where there is none."""
        if self.next is not None:
            return self.next[node * np.int32(self.width) + data]
        edge = node.astype(np.int64) * self.width + data
        at = np.searchsorted(self.edges, edge)
        return np.where(self.edges[at] == edge, self.ends[at], 0)

    def costs(self, texts: arrays.Texts) -> np.ndarray:
        """Code length of each byte in bits, a column per language."""
        data = self.classes[arrays.LOWER[texts.data]]
        n, starts = len(data), texts.bounds[:-1][np.diff(texts.bounds) > 0]
        known = at = self.step(np.ones(n, np.int32), data)
        known = np.maximum(known, 1)
        context = np.ones(n, np.int32)
        for d in range(1, self.order + 1):
            if d == self.order:
                context[1:] = known[:-1]
            at = at[1:] if d < n else at[:0]  # ends at the same byte as data from d on
            at = self.step(at, data[: len(at)])
            for j in range(d):  # a string stays in its text
                cut = starts + j - d
                at[cut[(cut >= 0) & (cut < len(at))]] = 0
            known[n - len(at) :] = np.maximum(known[n - len(at) :], at)
        if not self.order:
            context[:] = 1
        context[starts] = 1
        return self.bits[known] + self.escapes[context]


class Model:
    """The trees of all languages, by groups."""

    def __init__(self, langs: list[str], keys: np.ndarray, lang: np.ndarray, n: np.ndarray, order: int, cells: int, group: int = GROUP):
        self.langs, self.group, self.trees = langs, group, []
        groups = -(-len(langs) // group)
        for first in range(0, len(langs), group):
            mine = (lang >= first) & (lang < first + group)
            self.trees.append(Trees(keys[mine], lang[mine] - first, n[mine], min(group, len(langs) - first), order, cells // groups))

    def lengths(self, texts: arrays.Texts) -> np.ndarray:
        """Code length of each row in bits, a column per language."""
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(np.diff(texts.bounds))
        for k, trees in enumerate(self.trees if len(full) else []):
            out[full, k * self.group : (k + 1) * self.group] = np.add.reduceat(trees.costs(texts), texts.bounds[full], axis=0, dtype=np.float64)
        return out


def _has_letter(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_lang: int) -> DataFrame:
    """About ``per_lang`` rows of each language: a row stays if the hash of its id and text is under its
    language's share, and of repeated rows one stays. No language's rows are gathered in one task."""
    sizes = written(docs.groupBy(lang).agg(F.count("*").alias("rows_of_lang")), "langs")
    if sizes.count() <= LANGS:  # languages are few; should they not be, the texts are shuffled
        sizes = F.broadcast(sizes)
    share = F.lit(float(per_lang)) / F.col("rows_of_lang")
    hashed = docs.withColumn("hash_of_row", F.xxhash64(F.col(doc_id).cast("string"), F.col(text)))
    drawn = F.pmod(F.col("hash_of_row"), F.lit(1 << 30)) / float(1 << 30)
    return hashed.join(sizes, lang).where(drawn < share).dropDuplicates([lang, "hash_of_row"]).drop("rows_of_lang", "hash_of_row")


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER, per_lang: int = SAMPLE, cells: int = CELLS, least: int = 2) -> Model:
    """Trees of every non-null language among ``docs``, from rows with a letter in their text. Beyond order 0, pairs of
    context and byte seen less than ``least`` times are left out; with 1 all stay."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")

    def count(batch, texts):
        data = arrays.LOWER[texts.data].astype(np.int64)
        place = np.arange(len(data)) - np.repeat(texts.bounds[:-1], np.diff(texts.bounds))
        codes, which = np.unique(batch["lang"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        whose = np.repeat(which, np.diff(texts.bounds))
        names, keys, ns = [], [], []
        for i, code in enumerate(codes):
            key, mine = data.copy(), whose == i
            for d in range(order + 1):
                if d:
                    key[d:] += data[:-d] << (8 * d)
                found, n = np.unique(key[mine & (place >= d)] | (d << 56), return_counts=True)
                names += [str(code)] * len(found)
                keys.append(found)
                ns.append(n)
        return arrays.batch(lang=arrays.strings(names), key=np.concatenate(keys or [np.zeros(0, np.int64)]), n=np.concatenate(ns or [np.zeros(0, np.int64)]))

    counted = arrays.map_texts(sample(known, "doc_id", "text", "lang", per_lang), count, "lang string, key long, n long")
    total = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).where(F.expr("shiftright(key, 56) = 0") | (F.col("n") >= least))
    rows = total.toArrow()
    names = rows["lang"].to_numpy().astype(str)
    langs = sorted(set(names))
    code = {x: i for i, x in enumerate(langs)}
    return Model(langs, rows["key"].to_numpy().astype(np.int64), np.array([code[x] for x in names], np.int64), rows["n"].to_numpy(), order, cells)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per row, ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[F.col(c) for c in keep], F.col(text).alias("text_of_row"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]) + ", lang_pred string, score double"

    def run(batch, texts):
        trees = shared.value
        letters = _has_letter(batch["text_of_row"])
        if trees.langs:
            bits = trees.lengths(texts)
            best = bits.argmin(axis=1)
            score = 1 / np.exp2(np.minimum(0, bits.min(axis=1)[:, None] - bits)).sum(axis=1)
        else:
            best, score, letters = np.zeros(len(texts), int), np.zeros(len(texts)), letters & False
        named = [trees.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return arrays.batch(**{c: batch[c] for c in keep}, lang_pred=arrays.strings(named), score=np.where(letters, score, 0.0))

    return arrays.map_texts(kept, run, schema, "text_of_row", BLOCK_BYTES)


def identified(docs: DataFrame, model: Model, min_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose language is found with at least ``min_score``, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch, texts):
        trees = shared.value
        keep = _has_letter(batch[text])
        if not trees.langs:
            return None
        bits = trees.lengths(texts)
        score = 1 / np.exp2(np.minimum(0, bits.min(axis=1)[:, None] - bits)).sum(axis=1)
        return batch.filter(pa.array(keep & (score >= min_score)))

    return arrays.map_texts(docs, run, docs.schema, text, BLOCK_BYTES)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold

"""Interpolated modified Kneser-Ney language model over words, counted in Spark, scored from mapped files.

Tokens are the words of a text (A-Z lower-cased, separated by ASCII white space) and one end. The model is a
bigram model: P(w | u) = (c(uw) - D(c(uw))) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3+(u)) / c(u) * P1(w), with
P1 from continuation counts, discounted in the same way and interpolated with 1 / (V + 1). The discounts come from the
counts of counts (Chen and Goodman), and fall back to 0.5, 1 and 1.5 where those are zero. An unseen context
leaves P1 alone; an unseen word has the uniform part. The probabilities after a context sum to 1.

1. Tasks send the distinct bigrams of about ``CHUNK_BYTES`` of text, sorted, as hashes, dealt by the
   leading bits of the first word's hash plus one of ``SPREAD`` offsets drawn from the second word, so that
   a word that starts a third of all bigrams is spread too. A bucket's task adds them up, writes
   the bigram file and returns what each word gets from it: totals and N1, N2, N3+ as a context,
   continuations and occurrences as a word.
2. Those sums are dealt by word, merged and written as word files.
3. Workers map the files and score whole texts; lookups of a block are sorted first.

Words and bigrams are told apart by 64-bit hashes, in the files of bigrams by the first word's leading 16 and 48
further bits.

Defined cases: a null or empty text is its end alone; rows with a null id take part as the id's empty text
says; repeated rows count and score each; with no training rows every token is unknown (N = V = 0: the base
score of a token is log10(1), its probability 1 / 1); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays, shards
from zonewatch.llm.shared import new_folder, written

CHUNK_BYTES = 16 << 20
SPREAD = 8
#: Words are counted and looked up by the upper 48 bits of their hashes.
BITS = np.uint64(0xFFFFFFFFFFFF0000)
#: Stand-ins for a text's start (a context only) and its end.
START, END = np.uint64(0x5354415254000000), np.uint64(0x454E440000000000)
#: Of a word as a context: its total, N1, N2, N3+. As a word: continuations, occurrences.
WORD_COLUMNS = ("<u8", "<u4", "<u4", "<u4", "<u4", "<u8")


def tokens(texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows in order, and the first token of each row and the end."""
    words = texts.words(arrays.SPACED)
    bounds = words.bounds + np.arange(len(texts) + 1)
    out = np.empty(bounds[-1], np.uint64)
    ends = bounds[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = words.hash & BITS, END
    return out, bounds


def contexts(toks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.empty_like(toks)
    out[1:] = toks[:-1]
    out[bounds[:-1]] = START
    return out


def salted(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The first word's hash, moved by one of ``SPREAD`` even steps that depends on the second word."""
    return u + ((arrays.mixed(w) % np.uint64(SPREAD)) << np.uint64(61))


def bigram(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    top = salted(u, w) & np.uint64(0xFFFF << 48)
    return top | (arrays.mixed(u ^ arrays.mixed(w + np.uint64(arrays.WORD_BASE))) >> np.uint64(16))


def discounts(counts_of_counts: list[float]) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = counts_of_counts
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    ok = [d if 0 < d <= k else k / 2 for k, d in ((1, d1), (2, d2), (3, d3))]
    return np.array([0.0, *ok])


class Model:
    """The files, the totals and the discounts of both orders."""

    def __init__(self, words: shards.Shards, bigrams: shards.Shards, tokens: int, vocabulary: int, continuations: int, of_bigrams: list[float], of_words: list[float], kinds: list[float]):
        self.words, self.bigrams = words, bigrams
        self.tokens, self.vocabulary, self.continuations = tokens, vocabulary, continuations
        self.d2, self.d1 = discounts(of_bigrams), discounts(of_words)
        #: What the discounts of the continuation counts leave for the uniform part. kinds: words with 1, 2, 3 or more.
        self.left = float(self.d1[1:] @ np.array(kinds)) / continuations if continuations else 1.0

    def scores(self, toks: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability and training count of each token after its context."""
        known, back = np.unique(np.append(toks, START), return_inverse=True)
        columns = self.words.find(known)
        w = back[:-1]
        u = np.where(before == START, back[-1], np.roll(w, 1))
        total, n1, n2, n3 = (c[u].astype(np.float64) for c in columns[:4])
        cont, count = columns[4][w].astype(np.float64), columns[5][w].astype(np.int64)
        uniform = 1.0 / (self.vocabulary + 1)
        low = uniform * self.left
        if self.continuations:
            low = low + np.maximum(cont - self.d1[np.minimum(cont, 3).astype(int)], 0) / self.continuations
        pairs = self.bigrams.find_any(bigram(before, toks))[0].astype(np.float64)
        seen = total > 0
        safe = np.where(seen, total, 1.0)
        high = np.maximum(pairs - self.d2[np.minimum(pairs, 3).astype(int)], 0) / safe
        left = (self.d2[1] * n1 + self.d2[2] * n2 + self.d2[3] * n3) / safe
        return np.log10(np.where(seen, high + left * low, low)), count


def learn(docs: DataFrame, text: str = "text") -> Model:
    spark = docs.sparkSession
    n = shards.buckets(spark)

    def count(batches):
        held, bytes_held = [], 0

        def sent():
            u, w = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            keys = bigram(u, w)
            order = np.argsort(keys)
            keys = keys[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times = np.diff(np.append(at, len(keys)))
            keys, u, w = keys[at], u[order[at]], w[order[at]]
            cuts = shards.bounds(keys, n)
            for b in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[b], cuts[b + 1])
                o = np.argsort(u[part], kind="stable")  # a context is sent once, with the number of its words
                first, runs = shards.counted(u[part][o])
                blobs = {"u": shards.six(first), "runs": runs.astype("<u4").tobytes(), "w": shards.six(w[part][o]), "times": times[part][o].astype("<u4").tobytes()}
                yield arrays.batch(bucket=pa.array([int(b)], pa.int32()), **{c: pa.array([x], pa.binary()) for c, x in blobs.items()})

        for _, texts in arrays.blocks(batches, "text"):
            toks, bounds = tokens(texts)
            held.append((contexts(toks, bounds), toks))
            bytes_held += len(texts.data) + len(texts)
            if bytes_held >= CHUNK_BYTES:
                yield from sent()
                held, bytes_held = [], 0
        if held:
            yield from sent()

    folder = new_folder(spark, "bigrams")

    def merge(key, table):
        us, ws, ts = [], [], []
        for u, r, w, t in zip(*(table[c] for c in ("u", "runs", "w", "times")), strict=True):
            us.append(np.repeat(shards.unsix(u.as_py()), np.frombuffer(r.as_py(), "<u4")))
            ws.append(shards.unsix(w.as_py()))
            ts.append(np.frombuffer(t.as_py(), "<u4").astype(np.int64))
        u, w, t = np.concatenate(us), np.concatenate(ws), np.concatenate(ts)
        keys = bigram(u, w)
        order = np.argsort(keys)
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.add.reduceat(t[order], at)
        keys, u, w = keys[at], u[order[at]], w[order[at]]
        bucket, one = key[0].as_py(), np.ones(len(u), np.int64)
        path = shards.save(folder, bucket, [keys.astype("<u8"), times.astype("<u4")])
        as_context = shards.summed(u, times, times == 1, times == 2, times >= 3)
        as_word = shards.summed(w, one, times)
        rows = [{"bucket": bucket, "path": path, "n": len(keys), "times": [int((times == k).sum()) for k in (1, 2, 3, 4)]}]
        for kind, (words, *sums) in (("context", as_context), ("word", as_word)):
            cuts = shards.bounds(words, n)
            for b in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[b], cuts[b + 1])
                rows.append({"bucket": int(b), "kind": kind, "words": shards.six(words[part]), "sums": [s[part].astype("<u4").tobytes() for s in sums]})
        return pa.Table.from_pylist(rows, PARTS)

    raw = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, u binary, runs binary, w binary, times binary")
    parts = written(raw.groupBy("bucket").applyInArrow(merge, "bucket int, path string, n long, times array<long>, kind string, words binary, sums array<binary>"), "word-sums")
    made = parts.where("path IS NOT NULL").select("bucket", "path", "n", "times").toArrow()
    bigrams = shards.Shards(n, ("<u4",), {r["bucket"]: (r["path"], r["n"]) for r in made.to_pylist()})
    of_bigrams = np.array(made["times"].to_pylist() or [[0] * 4]).sum(axis=0).tolist()

    def merge_words(table):
        keys, columns = [], []
        for kind, words, sums in zip(*(table[c] for c in ("kind", "words", "sums")), strict=True):
            found = [np.frombuffer(s.as_py(), "<u4").astype(np.int64) for s in sums]
            none = np.zeros(len(found[0]), np.int64)
            keys.append(shards.unsix(words.as_py()))
            columns.append([*found, none, none] if kind.as_py() == "context" else [none, none, none, none, *found])
        keys, *sums = shards.summed(np.concatenate(keys), *(np.concatenate([c[k] for c in columns]) for k in range(6)))
        cont, times = sums[4], sums[5]
        numbers = {"tokens": times.sum(), "vocabulary": (times > 0).sum(), "more": (cont >= 3).sum()} | {f"c{k}": (cont == k).sum() for k in (1, 2, 3, 4)}
        return keys, sums, numbers

    words, stats = shards.store(parts.where("path IS NULL").select("bucket", "kind", "words", "sums"), merge_words, WORD_COLUMNS, n, "tokens vocabulary more c1 c2 c3 c4")
    total = {c: int(sum(stats[c].to_pylist())) for c in ("tokens", "vocabulary", "more", "c1", "c2", "c3", "c4")}
    counts = [total[f"c{k}"] for k in (1, 2, 3, 4)]
    return Model(words, bigrams, total["tokens"], total["vocabulary"], sum(n for _, n in bigrams.files.values()), of_bigrams, counts, [counts[0], counts[1], total["more"]])


PARTS = pa.schema([("bucket", pa.int32()), ("path", pa.string()), ("n", pa.int64()), ("times", pa.list_(pa.int64())), ("kind", pa.string()), ("words", pa.binary()), ("sums", pa.list_(pa.binary()))])


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and per row n_tokens, n_known, train_tokens, base_score (unigrams, add one), score and perplexity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[F.col(c) for c in keep], F.col(text).alias("text_of_row"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]) + ", n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batch, texts):
        lm = shared.value
        toks, bounds = tokens(texts)
        logp, count = lm.scores(toks, contexts(toks, bounds))
        base = np.log10((count + 1) / (lm.tokens + lm.vocabulary + 1))
        sums = [np.add.reduceat(x, bounds[:-1]) for x in ((count > 0).astype(np.int64), base, logp)]
        sizes = np.diff(bounds)
        return arrays.batch(**{c: batch[c] for c in keep}, n_tokens=sizes, n_known=sums[0], train_tokens=np.full(len(batch), lm.tokens, np.int64), base_score=sums[1], score=sums[2], perplexity=10 ** (-sums[2] / sizes))

    return arrays.map_texts(kept, run, schema, "text_of_row")

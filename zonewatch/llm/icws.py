"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five consecutive words (lower-cased runs of digits, letters and characters beyond ASCII); a
text with fewer words, but not none, is one shingle. Its weight is its count in the text times
``idf = 3/4 + 1/4 * ln(1 + N / df) / ln(1 + N)``. The floor keeps a shingle that a large group of near
copies shares from losing its weight, as it would under a plain logarithm, and the rest holds down common
passages. df is counted over all documents, exactly up to collisions of 48-bit hashes.

1. One pass counts the shingles: tasks send sorted distinct hashes by bucket, a bucket's task keeps
   those with df of 2 or more in a sorted file that workers map (others have df 1).
2. One pass draws ``BANDS * ROWS`` samples per text (a shingle and its quantised weight; two texts draw
   the same with the probability of their weighted Jaccard similarity) and a hash of the word sequence.
   Texts with the same words are one class at once, whatever their number; only one goes on.
3. Texts that agree in a band are candidates. No bucket is expanded into rows of pairs: in each round a
   bucket's members are compared with one of them, links are verified on the texts and contracted, and
   the next round takes another one. Of buckets that are still apart, the members meet in pairs of tiles of
   ``TILE``, where every candidate pair of different components is verified by matrix products and
   a spanning forest of the links comes out. So no link is lost to a cap, and n copies cost n rows a tile.
4. A candidate is first held against all samples (fewer than ``AGREE`` common ones: dropped, at a similarity
   of 0.8 one in some thousands) and then verified by the weighted Jaccard similarity of the two texts.

At a similarity of 0.8 a pair meets in a band with a probability of 0.999.

Defined cases: a null text and a text without words are their own class; a null id takes the class of its
text if that has an id, else null, and is never a representative; repeated rows give a row each; rows with one id
and different texts share the id's class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays, shards
from zonewatch.llm.shared import components, forest, some_of, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, AGREE = 10, 3, 16
ROUNDS, TILE = 2, 512
#: Features of a slice of the matrix products.
FEATURES = 2048
#: Bytes of text whose shingles a task counts before it sends them on.
CHUNK_BYTES = 16 << 20
FLOOR = 0.75


def shingles(texts: arrays.Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, arrays.Words]:
    """(row, key, count) of each distinct shingle, by row and key, and the words. Keys are the upper 48 bits."""
    words = texts.words()
    at, h = words.windows(size)
    rows, counts = words.rows()[at], words.counts()
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        sums = arrays.prefix_sums(words.hash, arrays.WORD_BASE)
        h = np.concatenate([h, arrays.range_hashes(sums, words.bounds[few], words.bounds[few + 1], arrays.WORD_BASE)])
        rows = np.concatenate([rows, few])
    packed, n = shards.counted(np.sort((rows.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16))))
    return (packed >> np.uint64(48)).astype(np.int64), packed << np.uint64(16), n, words


class Weights:
    """idf of shingles from the kept document frequencies."""

    def __init__(self, table: shards.Shards, documents: int):
        self.table, self.documents = table, documents

    def idf(self, keys: np.ndarray) -> np.ndarray:
        df = np.maximum(self.table.find_any(keys)[0], 1).astype(np.float64)
        return FLOOR + (1 - FLOOR) * np.log1p(self.documents / df) / np.log1p(max(1, self.documents))


def frequencies(docs: DataFrame, size: int) -> Weights:
    """Document frequencies of all shingles of ``docs`` (text)."""
    n = shards.buckets(docs.sparkSession)

    def count(batches):
        held, bytes_held, documents = [], 0, 0

        def sent():
            keys, times = shards.counted(np.sort(np.concatenate(held)))
            cuts = shards.bounds(keys, n)
            for b in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[b], cuts[b + 1])
                several = times[part] > 1
                yield arrays.batch(
                    bucket=pa.array([int(b)], pa.int32()),
                    keys=pa.array([shards.six(keys[part])], pa.binary()),
                    several=pa.array([np.flatnonzero(several).astype("<u4").tobytes()], pa.binary()),
                    times=pa.array([times[part][several].astype("<u4").tobytes()], pa.binary()),
                    documents=pa.array([0], pa.int64()),
                )

        for _, texts in arrays.blocks(batches, "text"):
            _, keys, _, words = shingles(texts, size)
            held.append(keys)
            bytes_held += len(texts.data)
            documents += int((words.counts() > 0).sum())
            if bytes_held >= CHUNK_BYTES:
                yield from sent()
                held, bytes_held = [], 0
        if bytes_held:
            yield from sent()
        if documents:
            yield arrays.batch(bucket=pa.array([0], pa.int32()), keys=pa.array([b""]), several=pa.array([b""]), times=pa.array([b""]), documents=pa.array([documents], pa.int64()))

    def merge(table):
        keys, times = [], []
        for k, s, t in zip(*(table[c] for c in ("keys", "several", "times")), strict=True):
            part = shards.unsix(k.as_py())
            n = np.ones(len(part), np.int64)
            n[np.frombuffer(s.as_py(), "<u4")] = np.frombuffer(t.as_py(), "<u4")
            keys.append(part)
            times.append(n)
        keys, times = shards.summed(np.concatenate(keys), np.concatenate(times))
        return keys[times > 1], [times[times > 1]], {"documents": sum(table["documents"].to_pylist())}

    parts = docs.select("text").mapInArrow(count, "bucket int, keys binary, several binary, times binary, documents long")
    table, made = shards.store(parts, merge, ("<u4",), n, "documents")
    return Weights(table, int(sum(made["documents"].to_pylist())))


def samples(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, count: int, n: int) -> np.ndarray:
    """``n`` consistent weighted samples of each row (rows ascending, ``count`` of them), as 32-bit hashes."""
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    present, sizes = rows[first], np.diff(np.append(first, len(rows)))
    log_w = np.log(weights).astype(np.float32)
    out = np.zeros((count, n), np.uint32)
    unit, low = np.float32(2.0**-24), np.uint64(0xFFFFFF)
    for s in range(n):
        seed = arrays.mixed(np.array([s + 1], np.uint64)) | np.uint64(1)
        u = keys * seed
        u ^= u >> np.uint64(32)
        u *= np.uint64(0xBF58476D1CE4E5B9)
        u ^= u >> np.uint64(29)
        v = u * np.uint64(0x94D049BB133111EB)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(29)
        # r and c are Gamma(2, 1), beta is uniform; all of them belong to the shingle and the sample
        r = -np.log(((u >> np.uint64(40)).astype(np.float32) + 1) * unit * (((u >> np.uint64(16)) & low).astype(np.float32) + 1) * unit) + np.float32(1e-6)
        c = -np.log(((v >> np.uint64(40)).astype(np.float32) + 1) * unit * (((v >> np.uint64(16)) & low).astype(np.float32) + 1) * unit) + np.float32(1e-9)
        beta = ((((u & np.uint64(0xFFFF)) << np.uint64(8)) | (v & np.uint64(0xFF))).astype(np.float32)) * unit
        t = np.floor(log_w / r + beta)
        a = np.log(c) - r * (t - beta + 1)
        least = np.minimum.reduceat(a, first)
        at = np.flatnonzero(a == np.repeat(least, sizes))
        at = at[np.concatenate([[True], rows[at][1:] != rows[at][:-1]])]
        drawn = keys[at] ^ (t[at].astype(np.int64).astype(np.uint64) * np.uint64(arrays.BYTE_BASE))
        out[present, s] = (arrays.mixed(drawn) >> np.uint64(32)).astype(np.uint32)
    return out


def signatures(docs: DataFrame, weights: Broadcast, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, h1, h2, sig, bands) of ``docs`` (doc_id, text); all but the id null without words."""

    def run(batch, texts):
        row, keys, n, words = shingles(texts, size)
        count = len(texts)
        sig = np.zeros((count, bands * rows), np.uint32)
        idf = weights.value.idf(keys)
        # a few thousand rows of 64-bit numbers at a time stay in the cache
        cuts = np.flatnonzero(np.diff(row)) + 1
        edges, at = [0], 0
        while at < len(row):
            to = cuts[np.searchsorted(cuts, at + (1 << 15))] if len(cuts) and cuts[-1] >= at + (1 << 15) else len(row)
            edges.append(to)
            at = to
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            base = row[a]
            part = samples(row[a:b] - base, keys[a:b], n[a:b] * idf[a:b], int(row[b - 1] - base) + 1, bands * rows)
            sig[base : row[b - 1] + 1] = part
        some = words.counts() > 0
        hashes = [arrays.range_hashes(arrays.prefix_sums(h, arrays.WORD_BASE), words.bounds[:-1], words.bounds[1:], arrays.WORD_BASE) for h in (words.hash, arrays.mixed(words.hash ^ np.uint64(arrays.BYTE_BASE)))]
        wide = sig.astype(np.uint64).reshape(count, bands, rows)
        keyed = np.zeros((count, bands), np.uint64)
        for k in range(rows):
            keyed = arrays.mixed(keyed * np.uint64(arrays.BYTE_BASE) + wide[:, :, k])
        none = ~some
        return arrays.batch(
            doc_id=batch["doc_id"],
            h1=pa.array(hashes[0].view(np.int64), mask=none),
            h2=pa.array(hashes[1].view(np.int64), mask=none),
            sig=pa.array([s.tobytes() if ok else None for s, ok in zip(sig, some, strict=True)], pa.binary()),
            bands=pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * bands), pa.array(keyed.ravel().view(np.int64))),
        )

    return arrays.map_texts(docs.select("doc_id", "text"), run, "doc_id long, h1 long, h2 long, sig binary, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (keys ascending, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, weights: Broadcast, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold. Only texts of the pairs are moved."""
    own = some_of(texts, pairs.selectExpr("stack(2, a, b) AS doc_id").distinct(), "doc_id")
    both = pairs.join(own.toDF("a", "text"), "a").join(own.toDF("b", "text_b"), "b").select("a", "b", "text", "text_b")

    def weighted(block):
        row, keys, n, _ = shingles(block, size)
        cuts = np.searchsorted(row, np.arange(len(block) + 1))
        w = n * weights.value.idf(keys)
        return [(keys[s:e], w[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]

    def run(batch, block):
        left, right = weighted(block), weighted(arrays.as_texts(batch["text_b"]))
        keep = pa.array([similarity(x, y) >= threshold for x, y in zip(left, right, strict=True)], pa.bool_())
        return batch.select(["a", "b"]).filter(keep)

    return written(arrays.map_texts(both, run, "a long, b long"), "near-links")


def agreeing(pairs: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that share at least ``least`` samples."""
    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")

    def run(batches):
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(len(batch), -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def similarities(texts: arrays.Texts, weights: Weights, size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarities of the rows ``left`` with the rows ``right``.

    A shingle that occurs n times is n features of its idf, so what two texts share is an inner product: all pairs
    come from matrix products, a slice of the features at a time. Features of one text alone count in its total only."""
    row, keys, n, _ = shingles(texts, size)
    idf = weights.idf(keys)
    total = np.bincount(row, weights=n * idf, minlength=len(texts))
    level = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    feature = arrays.mixed(np.repeat(keys, n) + level.astype(np.uint64))
    row, idf = np.repeat(row, n), np.repeat(idf, n)
    _, column, count = np.unique(feature, return_inverse=True, return_counts=True)
    many = np.flatnonzero(count[column] > 1)
    number = np.cumsum(count > 1) - 1
    row, idf, column = row[many], idf[many], number[column[many]]
    order = np.argsort(column, kind="stable")
    row, idf, column = row[order], idf[order], column[order]
    common = np.zeros((len(left), len(right)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, FEATURES):
        s, e = np.searchsorted(column, [at, at + FEATURES])
        x = np.zeros((len(texts), FEATURES))
        x[row[s:e], column[s:e] - at] = np.sqrt(idf[s:e])
        common += x[left] @ x[right].T
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.nan_to_num(common / (total[left][:, None] + total[right][None, :] - common))


def candidates(sig: np.ndarray, left: np.ndarray, right: np.ndarray, band: int, rows: int, least: int) -> np.ndarray:
    """Which pairs share ``least`` samples and meet in no band before ``band``, where they are looked at."""
    common = np.zeros((len(left), len(right)), np.int16)
    before = np.zeros(common.shape, bool)
    for b in range(sig.shape[1] // rows):
        whole = np.ones(common.shape, bool)
        for k in range(b * rows, (b + 1) * rows):
            same = sig[left, k][:, None] == sig[right, k][None, :]
            common += same
            whole &= same
        if b < band:
            before |= whole
    return (common >= least) & ~before


def tiled_links(members: DataFrame, sigs: DataFrame, texts: DataFrame, weights: Broadcast, size: int, threshold: float, rows: int, least: int, tile: int) -> DataFrame:
    """Links (a, b) between different components of a bucket (bucket, band, node, comp): every candidate pair is
    verified where its tiles meet, and a tile returns a spanning forest of its links."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).selectExpr("bucket", f"cast(ceil(n / {tile}) AS int) AS tiles")
    data = sigs.withColumnRenamed("doc_id", "node").join(texts.withColumnRenamed("doc_id", "node"), "node")
    dealt = members.join(sizes, "bucket").join(data, "node")
    dealt = dealt.withColumn("own", F.expr("pmod(xxhash64(node), tiles)")).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    dealt = dealt.selectExpr("bucket", "band", "least(own, other) AS i", "greatest(own, other) AS j", "own", "node", "comp", "sig", "text")

    def run(table):
        own, node, comp = (table[c].to_numpy() for c in ("own", "node", "comp"))
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(len(node), -1)
        i, j, band = (table[c][0].as_py() for c in ("i", "j", "band"))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        pairs = candidates(sig, left, right, band, rows, least) & (comp[left][:, None] != comp[right][None, :])
        if i == j:
            pairs = np.triu(pairs, 1)
        edges = []
        if pairs.any():
            left, right, pairs = left[pairs.any(axis=1)], right[pairs.any(axis=0)], pairs[pairs.any(axis=1)][:, pairs.any(axis=0)]
            used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
            block = arrays.as_texts(table["text"].combine_chunks().take(pa.array(used)))
            x, y = place[: len(left)], place[len(left) :]
            a, b = np.nonzero(pairs & (similarities(block, weights.value, size, x, y) >= threshold))
            edges = [(int(node[used[u]]), int(node[used[v]])) for u, v in forest(x[a], y[b], len(used))]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return written(dealt.groupBy("bucket", "band", "i", "j").applyInArrow(run, "a long, b long"), "tile-links")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, agree: int = AGREE, rounds: int = ROUNDS, tile: int = TILE) -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its class), n_copies (rows with the same words), kept."""
    spark = docs.sparkSession
    rows_in = docs.selectExpr(f"cast(`{doc_id}` AS long) AS doc_id", f"`{text}` AS text")
    weights = spark.sparkContext.broadcast(frequencies(rows_in, size))
    signed = written(signatures(rows_in, weights, size, bands, rows), "signatures")
    # texts with the same words have the same samples
    grouped = signed.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    same = written(grouped, "same-words")
    reps = same.where("rep IS NOT NULL")
    sigs = reps.selectExpr("rep AS doc_id", "sig").dropDuplicates(["doc_id"])
    banded = reps.selectExpr("rep AS node", "posexplode(bands) AS (band, key)").selectExpr("xxhash64(band, key) AS bucket", "band", "node")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = written(banded.join(shared, "bucket"), "bucket-members")
    nodes = members.selectExpr("node AS doc_id").distinct()
    texts = some_of(rows_in.where("doc_id IS NOT NULL"), nodes, "doc_id")
    if not signed.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id"])
    texts = written(texts, "candidate-texts")
    label = nodes.selectExpr("doc_id AS node", "doc_id AS comp")
    done = spark.createDataFrame([], "a long, b long")
    for turn in range(rounds + 1):
        placed = members.join(label, "node")
        apart = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.expr(f"min_by(node, xxhash64(node, {turn}))").alias("lead"), F.expr(f"min_by(comp, xxhash64(node, {turn}))").alias("lead_comp")).where("low < high")
        if turn < rounds:
            pairs = placed.join(apart, "bucket").where("comp <> lead_comp").selectExpr("least(node, lead) AS a", "greatest(node, lead) AS b").distinct()
            pairs = written(agreeing(pairs.join(done, ["a", "b"], "left_anti"), sigs, agree), "candidates")
            links = verified(pairs, texts, weights, size, threshold)
            done = done.union(pairs)
        else:
            links = tiled_links(placed.join(apart.select("bucket"), "bucket", "left_semi"), sigs, texts, weights, size, threshold, rows, agree, tile)
        # only components that a new link touches can change
        between = links.join(label.toDF("a", "ca"), "a").join(label.toDF("b", "cb"), "b").selectExpr("ca AS a", "cb AS b").where("a <> b")
        label = label.join(components(between).toDF("comp", "component"), "comp", "left").selectExpr("node", "coalesce(component, comp) AS comp")
        label = written(label, "classes")
    named = same.join(label.toDF("rep", "comp"), "rep", "left").selectExpr("h1", "h2", "n_copies", "coalesce(comp, rep) AS class_id")
    several = named.where("n_copies > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    ids = signed.select("doc_id", "h1", "h2").withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(16)))
    # a class of copies may hold a third of all rows: dealt over the salts; all others have one row here
    # texts without words would meet in one task of a join
    bare, ids = ids.where("h1 IS NULL").selectExpr("doc_id", "doc_id AS class_id", "1L AS n_copies"), ids.where("h1 IS NOT NULL")
    copies = ids.join(several, ["h1", "h2", "salt"]).select("doc_id", "class_id", "n_copies")
    single = ids.join(several, ["h1", "h2", "salt"], "left_anti").join(named.where("n_copies = 1"), ["h1", "h2"], "left")
    single = single.select("doc_id", "class_id", "n_copies")
    return bare.unionByName(copies).unionByName(single).withColumn("kept", F.expr("coalesce(doc_id = class_id, false)"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents, all columns, without those of a class that are not its representative. Of rows that share the
    representative's id one stays; rows with a null id stay."""
    found = written(classes(docs, doc_id, text, **how).where("doc_id IS NOT NULL"), "near-classes")
    gone = found.where("NOT kept").select(F.col("doc_id").alias(doc_id)).distinct()
    left = some_of(docs, gone, doc_id, "left_anti")
    several = found.where("kept").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(doc_id))
    if several.isEmpty():
        return left
    return some_of(left, several, doc_id, "left_anti").unionByName(some_of(left, several, doc_id).dropDuplicates([doc_id]))

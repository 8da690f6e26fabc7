"""Near-duplicate vectors within a label, by tiled comparison in principal-component order.

Vectors are scaled to length 1 and turned so that the leading dimensions hold most of their energy (the
eigenvectors of the second-moment matrix, summed in Spark; a turn keeps every inner product). Equal
vectors are folded into one with a weight. Each label's vectors are cut into tiles along the first
component; two tiles are compared only if the distance of their bounding boxes allows the threshold.
Inside a pair of tiles the leading dimensions are accumulated first; what the rest can add is at most
the product of the two suffix lengths (Cauchy-Schwarz), and a pair of vectors is dropped as soon as
that cannot reach the threshold. What remains is decided by the cosine of the original vectors in
double precision, so nothing is lost and nothing below the threshold is linked.

A pair of tiles returns sums per vector (links by weight) and a spanning forest of its links, never the
links themselves: a group of n near copies costs n rows per pair of
tiles, not n * n.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without
a label, link with nothing and are their own component; vectors of different lengths link with
nothing; repeated rows with one id count as vectors each and share a component; a null id gives a row
with a null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.shared import components, forest, written

THRESHOLD = 0.93
TILE_ROWS = 1024
#: Leading dimensions of the bounding boxes, and dimensions added per step.
BOX, STEP = 8, 8
RANGES, SALTS = 256, 16
#: Room for rounding where a bound prunes; the final test has none.
SLACK = 1e-6


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    v = vectors.selectExpr(f"cast(`{vec_id}` AS long) AS vec_id", f"cast(`{embedding}` AS array<double>) AS v", f"`{label}` AS label")
    finite = "NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return v.where(f"v IS NOT NULL AND size(v) > 0 AND label IS NOT NULL AND {finite} AND exists(v, x -> x <> 0)")


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def by_length(batch: pa.RecordBatch):
    sizes = np.diff(batch["v"].offsets.to_numpy())
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d))


def turns(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the rotation to principal components, most energy first."""

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, part in by_length(batch):
                x = unit(matrix(part["v"]))
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            n = d * d
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, d, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(m.ravel())], names=["d", "i", "m"])

    total = vectors.select("v").mapInArrow(moments, "d int, i int, m double").groupBy("d", "i").agg(F.sum("m").alias("m")).toArrow().to_pandas()
    out = {}
    for d, part in total.groupby("d"):
        m = np.zeros(d * d)
        m[part["i"]] = part["m"]
        _, axes = np.linalg.eigh(m.reshape(d, d))
        out[int(d)] = np.ascontiguousarray(axes[:, ::-1])
    return out


def tiles(distinct: DataFrame, axes: Broadcast, rows: int) -> DataFrame:
    """(label, d, tile, low, high, ids, weights, v): packed rows of each tile, about ``rows`` of them."""
    kind = distinct.schema["label"].dataType.simpleString()

    def first(batches):
        for batch in batches:
            x = np.zeros(len(batch))
            sizes = np.diff(batch["v"].offsets.to_numpy())
            for d, part in by_length(batch):
                x[sizes == d] = unit(matrix(part["v"])) @ axes.value[d][:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(x)], names=[*batch.schema.names, "d", "x"])

    placed = written(distinct.mapInArrow(first, f"vec_id long, v array<double>, label {kind}, weight long, d int, x double"), "tiles-in")
    # quantiles of the first component; equal values that fill more than a tile are dealt by a hash as well
    parts = placed.groupBy("label", "d").agg(F.count("*").alias("n"), F.percentile_approx("x", [i / RANGES for i in range(1, RANGES)], 5000).alias("q"))
    parts = parts.withColumn("parts", F.expr(f"least(ceil(n / {rows}), {RANGES})"))
    taken = f"filter(transform(sequence(1, {RANGES - 1}), i -> struct(i, q[i - 1] AS q)), s -> s.i * parts div {RANGES} <> (s.i - 1) * parts div {RANGES}).q"
    ranged = placed.join(parts.selectExpr("label", "d", f"{taken} AS q"), ["label", "d"]).selectExpr("label", "d", "vec_id", "weight", "v", "aggregate(q, 0, (n, b) -> n + if(x > b, 1, 0)) AS r")
    sizes = ranged.groupBy("label", "d", "r").agg(F.count("*").alias("n")).selectExpr("label", "d", "r", f"cast(ceil(n / {rows}) AS int) AS salts")
    dealt = ranged.join(sizes, ["label", "d", "r"]).selectExpr("label", "d", "concat_ws('.', r, pmod(xxhash64(vec_id, weight), salts)) AS tile", "vec_id", "weight", "v")

    def packed(key, table):
        d, x = key[1].as_py(), matrix(table["v"].combine_chunks())
        turned = (unit(x) @ axes.value[d])[:, :BOX]
        return pa.table({
            "label": table["label"].slice(0, 1),
            "d": pa.array([d], pa.int32()),
            "tile": table["tile"].slice(0, 1),
            "low": pa.array([turned.min(axis=0).tolist()]),
            "high": pa.array([turned.max(axis=0).tolist()]),
            "ids": pa.array([table["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "weights": pa.array([table["weight"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "v": pa.array([x.astype("<f8").tobytes()], pa.binary()),
        })

    schema = f"label {kind}, d int, tile string, low array<double>, high array<double>, ids binary, weights binary, v binary"
    return written(dealt.groupBy("label", "d", "tile").applyInArrow(packed, schema), "tiles")


def compared(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` whose cosine reaches the threshold; ``same``: of one tile, each pair once."""
    ta, tb = unit(a) @ turn, unit(b) @ turn
    d, done = ta.shape[1], min(2 * STEP, ta.shape[1])

    def rest(x, k):
        return np.sqrt((x[:, k:] ** 2).sum(axis=1))

    part = ta[:, :done] @ tb[:, :done].T
    alive = part + np.outer(rest(ta, done), rest(tb, done)) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    part = part[i, j]
    while done < d and len(i):
        to = min(d, done + STEP)
        out_i, out_j, out_p = [], [], []
        ra, rb = rest(ta, to), rest(tb, to)
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            s = part[at : at + (1 << 16)] + np.einsum("ij,ij->i", ta[p, done:to], tb[q, done:to])
            ok = s + ra[p] * rb[q] >= threshold - SLACK
            out_i.append(p[ok])
            out_j.append(q[ok])
            out_p.append(s[ok])
        i, j, part, done = np.concatenate(out_i), np.concatenate(out_j), np.concatenate(out_p), to
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    if not (np.isfinite(na).all() and np.isfinite(nb).all() and na.all() and nb.all()):
        a, b = unit(a), unit(b)
        na, nb = np.ones(len(a)), np.ones(len(b))
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        keep[at : at + (1 << 16)] = np.einsum("ij,ij->i", a[p], b[q]) / (na[p] * nb[q]) >= threshold
    return i[keep], j[keep]


def links(tiled: DataFrame, axes: Broadcast, threshold: float) -> DataFrame:
    """(a, b, n): with b null, a's links by weight; else an edge of a spanning forest."""
    boxes = tiled.select("label", "d", "tile", "low", "high")
    other = boxes.toDF("label", "d", "tile2", "low2", "high2")
    gaps = "zip_with(zip_with(low, high2, (x, y) -> greatest(x - y, 0D)), zip_with(low2, high, (x, y) -> greatest(x - y, 0D)), (x, y) -> greatest(x, y))"
    near = boxes.join(other, ["label", "d"]).where(f"tile <= tile2 AND aggregate({gaps}, 0D, (s, x) -> s + x * x) <= {2 - 2 * threshold + SLACK!r}")
    near = written(near.select("label", "d", "tile", "tile2"), "tile-pairs")
    packed = tiled.select("label", "d", "tile", "ids", "weights", "v")
    pairs = near.join(packed, ["label", "d", "tile"]).join(packed.toDF("label", "d", "tile2", "ids2", "weights2", "v2"), ["label", "d", "tile2"])

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch[c][k].as_py() for c in batch.schema.names}
                same, d = row["tile"] == row["tile2"], row["d"]
                sides = [(np.frombuffer(row["ids" + s], "<i8"), np.frombuffer(row["weights" + s], "<i8"), np.frombuffer(row["v" + s], "<f8").reshape(-1, d)) for s in ("", "2")]
                (ids, weights, a), (ids2, weights2, b) = sides
                i, j = compared(a, b, axes.value[d], threshold, same)
                if not len(i):
                    continue
                base = 0 if same else len(a)
                every, sums = (ids if same else np.concatenate([ids, ids2])), np.zeros(base + len(b), np.int64)
                np.add.at(sums, i, weights2[j])
                np.add.at(sums, j + base, weights[i])
                edges = forest(i, j + base, base + len(b))
                some = np.flatnonzero(sums)
                left = np.concatenate([every[some], every[[e[0] for e in edges]]]).astype(np.int64)
                right = pa.array([None] * len(some) + [int(every[e[1]]) for e in edges], pa.int64())
                n = np.concatenate([sums[some], np.zeros(len(edges), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(left), right, pa.array(n)], names=["a", "b", "n"])

    # a row holds two tiles, so a task gets a few of them, however many pairs there are
    width = max(tiled.sparkSession.sparkContext.defaultParallelism * 2, near.count() // 8)
    columns = ["d", "tile", "tile2", "ids", "weights", "v", "ids2", "weights2", "v2"]
    return written(pairs.select(*columns).repartition(width, "tile", "tile2", F.xxhash64("ids", "ids2")).mapInArrow(run, "a long, b long, n long"), "links")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (smallest id reachable), kept."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding, label).where("vec_id IS NOT NULL").selectExpr("vec_id", "label", "v", "xxhash64(v) AS h1", "xxhash64(v, 1) AS h2")
    classes = written(rows.groupBy("label", "h1", "h2", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vector-classes")
    distinct = classes.selectExpr("rep AS vec_id", "v", "label", "weight")
    axes = spark.sparkContext.broadcast(turns(distinct))
    found = links(tiles(distinct, axes, tile_rows), axes, threshold)
    joined = components(found.where("b IS NOT NULL").select("a", "b")).toDF("rep", "component")
    sums = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
    known = sums.join(joined, "rep", "left")
    several = classes.where("weight > 1").drop("v").join(known, "rep", "left")
    several = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    marked = vectors.selectExpr(f"cast(`{vec_id}` AS long) AS vec_id", f"`{label}` AS label", f"cast(`{embedding}` AS array<double>) AS v")
    marked = marked.selectExpr("vec_id", "label", "xxhash64(v) AS h1", "xxhash64(v, 1) AS h2")
    # a null id meets no salt, so it takes part in nothing
    marked = marked.withColumn("salt", F.expr(f"if(vec_id IS NULL, NULL, pmod(hash(vec_id), {SALTS}))"))
    key = ["label", "h1", "h2", "salt"]
    copies = marked.join(several, key).selectExpr("vec_id", "coalesce(n, 0) + weight - 1 AS n_links", "coalesce(component, rep) AS component_id")
    single = marked.join(several, key, "left_anti").join(known.withColumnRenamed("rep", "vec_id"), "vec_id", "left").selectExpr("vec_id", "coalesce(n, 0L) AS n_links", "coalesce(component, vec_id) AS component_id")
    return copies.unionByName(single).withColumn("kept", F.expr("coalesce(vec_id = component_id, false)"))

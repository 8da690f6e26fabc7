"""Tables and files in the folder that all executors share, and connected components on them."""

from __future__ import annotations

import random

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.session import run_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    spark, path = df.sparkSession, run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that tasks write and read by themselves, as a URI."""
    path = run_dir(spark, name)
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    folder, inside = opened(path)
    folder.create_dir(inside, recursive=True)
    return path


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that join the same nodes as all the links i-j do: each node with the least of its component."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        then = least.copy()
        np.minimum.at(then, i, low)
        np.minimum.at(then, j, low)
        then = then[then]
        if (then == least).all():
            break
        least = then
    return [(k, int(m)) for k, m in enumerate(least) if k != m]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs); a component is named by its smallest node.

    Each round points every node to the first of itself and its neighbours in an order that changes from
    round to round (ids xor a constant, which is one to one and undone by itself), follows the pointers
    four steps, and contracts the edges to where they lead. Stars around a small id are gone after the
    first round, whose order is that of the ids; long chains shrink by a constant factor a round. All of it
    is grouping by minima and equi-joins, so a hub is pre-aggregated in each task. Each round is
    written, so a lost executor costs one round at most. Self-loops are allowed, rows with a null are
    passed over, an empty table gives an empty one.
    """
    pairs = written(edges.selectExpr("cast(a AS long) AS a", "cast(b AS long) AS b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    labels = pairs.selectExpr("stack(2, a, b) AS node").distinct().withColumn("at", F.col("node"))
    pairs, order = pairs.where("a <> b"), random.Random(1)
    mask = 0
    while not pairs.isEmpty():
        first = pairs.union(pairs.selectExpr("b", "a")).toDF("u", "v").groupBy("u").agg(F.expr(f"min(v ^ {mask}L)").alias("r"))
        step = written(first.selectExpr("u", f"least(r, u ^ {mask}L) ^ {mask}L AS m"), "pointers")
        for _ in range(2):
            step = step.join(step.toDF("m", "further"), "m").selectExpr("u", "further AS m")
        own = written(step, "contracted")
        pairs = pairs.join(own.toDF("a", "ma"), "a").join(own.toDF("b", "mb"), "b").selectExpr("least(ma, mb) AS a", "greatest(ma, mb) AS b")
        pairs = written(pairs.where("a <> b").distinct(), "edges")
        labels = labels.join(own.toDF("at", "m"), "at", "left").selectExpr("node", "coalesce(m, at) AS at")
        mask = order.getrandbits(62)
    labels = written(labels, "labels")
    return labels.join(labels.groupBy("at").agg(F.min("node").alias("component")), "at").select("node", "component")


#: Ids up to this number (32 MB) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def some_of(rows: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``key`` is among ``ids`` (or, with left_anti, is not). The ids are counted first: while
    they fit, the rows are filtered in place and their texts are not shuffled."""
    ids = written(ids.select(key), "ids")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)

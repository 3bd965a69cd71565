"""Connected components of links: of few on the driver, else by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hot_join


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """`rows` with `m` of their node; nodes of many rows are broadcast, see hot_join."""
    return hot_join(rows, least, ["a"], "copies")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("copies")))
    return _with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = cut(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("copies")))
    moved = _with_least(down, least).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


#: Links that the driver joins itself, some 20 MB; every round on DataFrames plans and compiles several steps there.
FEW_LINKS = 100_000


def _joined(edges: DataFrame) -> DataFrame:
    """components() of few links, by union-find with the smallest node as the root."""
    found = edges.toArrow()
    above: dict = {}

    def root(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for a, b in zip(*(c.to_pylist() for c in found.columns), strict=True):
        low, high = sorted((root(a), root(b)))
        above[high] = low
    nodes = list(above)
    kind = found.schema.field(0).type
    return edges.sparkSession.createDataFrame(pa.table({"node": pa.array(nodes, kind), "component": pa.array([root(x) for x in nodes], kind)}))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `links`; component is the smallest node that it reaches.

    A hot node's links are joined by a broadcast of the hot nodes (a bounded number), never gathered. Every round is cut off in the shared folder; the number of rounds
    grows with the logarithm of the longest chain. Links with a null end or to themselves are ignored.
    """
    edges = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    if edges.limit(FEW_LINKS + 1).count() <= FEW_LINKS:
        return _joined(edges)
    state = None
    while True:
        edges = cut(_small_star(cut(_large_star(edges))))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

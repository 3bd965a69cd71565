"""Sharding: longest-processing-time scheduling of groups that must stay together.

Groups (rows with equal texts) are taken from the largest to the smallest; each goes to the least-loaded shard, held in
a heap. Groups of the same size are alike to that rule, so the driver gets only the histogram of group sizes. The number
of distinct sizes is at most the square root of twice the total size; it never holds groups or documents. A class of
equal-sized groups is dealt out as counts per shard, and every group finds its shard by its rank in its class.

Defined cases: a null text counts no bytes and is grouped with the empty text; repeated rows are rows of one group; an
empty table gives an empty table; only the columns named in the arguments are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, sharing

#: Rows that one task numbers at most, about; larger classes and shards are numbered in parts.
PER_TASK = 50_000


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of `size` each shard gets when every group goes to the least-loaded shard.

    Few groups go through the heap one by one. For many, the heap's choices are the `count` smallest of all values
    load + i * size, found by bisection; ties go to the shard that comes first, as in the heap.
    """
    shards = len(loads)
    got = [0] * shards
    if count <= 4 * shards:
        heap = [(load, j) for j, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(count):
            load, j = heap[0]
            heapq.heapreplace(heap, (load + size, j))
            got[j] += 1
        return got
    low, high = min(loads), max(loads) + size * count
    taken = lambda top: sum((top - x) // size + 1 for x in loads if x <= top)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if taken(mid) >= count else (mid + 1, high)
    got = [max(0, (low - x) // size + 1) for x in loads]
    over = sum(got) - count
    for j in reversed(range(shards)):
        if over and got[j] and loads[j] + (got[j] - 1) * size == low:
            got[j] -= 1
            over -= 1
    return got


def schedule(histogram: Iterable[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(size, first rank, rank after the last, shard) for every class of a histogram (size, groups)."""
    loads, runs = [0] * shards, []
    for size, count in sorted(histogram, reverse=True):
        at = 0
        for j, n in enumerate(deal(loads, max(size, 1), count)):
            if n:
                runs.append((size, at, at + n, j))
                at += n
                loads[j] += n * size
    return runs


def numbered(df: DataFrame, keys: list[str], order: list[str], rows: int, out: str) -> DataFrame:
    """`df` with `out`: 0, 1, ... within `keys`. A key's rows are numbered in parts, of which each knows what came before."""
    salts = sharing(df, PER_TASK, rows)
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    parts = salted.groupBy(*keys, "__salt").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys, "__salt").orderBy(*order)
    ranked = salted.withColumn("__k", F.row_number().over(within))
    return ranked.join(parts, [*keys, "__salt"]).withColumn(out, F.col("__before") + F.col("__k") - 1).drop("__salt", "__k", "__before")


def shard(df: DataFrame, shards: int, key: str = "key", size: str = "size", order: list[str] | None = None) -> DataFrame:
    """`df` with `shard` and `slot` (gapless within a shard); rows of equal `key` share a shard.

    Sizes are whole numbers of at least 0. `order` breaks ties in the numbering. `df` is read several times: hand over
    a narrow, materialised one.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = df.sparkSession
    groups = df.groupBy(key).agg(F.sum(size).alias("__size"))
    histogram = [(r[0], r[1]) for r in groups.groupBy("__size").count().collect()]
    runs = schedule(histogram, shards)
    plan = spark.createDataFrame(runs or [(0, 0, 0, 0)], "__size long, __from long, __to long, shard int")
    ranked = numbered(groups, ["__size"], [key], max((c for _, c in histogram), default=0), "__rank")
    placed = ranked.join(plan, "__size").where("__rank >= __from and __rank < __to").select(key, "shard")
    rows = df.count()
    out = df.drop("shard", "slot").join(placed, key)
    return numbered(out, ["shard"], order or [key], sharing(df, shards, rows), "slot")


def text_key(text):
    """Equal texts, equal keys: 128 bits."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def op8_sharding(spark: SparkSession, sf_dir: str, shards: int = 24) -> DataFrame:
    """All documents in shards of nearly equal bytes; equal texts stay together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key(F.col("text")).alias("key"),
    )
    placed = shard(cut(docs), shards, order=["doc_id", "key"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

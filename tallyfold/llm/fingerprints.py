"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a text's shingles (five words, lower-cased,
split at ASCII white space). Sketches of parts merge into the sketch of the union; two sketches estimate resemblance
(Jaccard), containment and distinct shingle counts. All of it is native Spark functions on arrays, row by row.

Defined cases: a null or empty text, or one of white space only, has the empty sketch; a text of fewer than five words
is one shingle; two empty sketches resemble each other fully; an empty table gives an empty table; repeated rows have
equal sketches; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 256
SHINGLE = 5
#: Rows of a range of keys, about, within which neighbours are found, and the most such ranges (two numbers each on the driver;
#: beyond some 130 million documents ranges grow, sorted in one task each, which spills).
RANGE_ROWS, MAX_RANGES = 2_000, 65_536

NO_HASHES = "array<bigint>"


def words_of(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\t-\r ]+"), "")


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """A hash for each shingle, repeats included. `words` must be a plain column, as it is used many times."""
    size = F.size(words)
    each = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(size >= n, each).when(size > 0, short).otherwise(F.array().cast(NO_HASHES))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, n: int = SHINGLE) -> DataFrame:
    """`df` with the sketch of column `text` in column `out`."""
    return df.withColumn("__words", words_of(F.col(text))).withColumn(out, bottom(shingle_hashes(F.col("__words"), n), k)).drop("__words")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated Jaccard similarity, exact for sets smaller than k."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct_count(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles, exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / F.greatest(share, F.lit(2.0**-64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has; an empty set is contained in any."""
    both = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / F.greatest(distinct_count(a, k), F.lit(1.0))))


def merge_by(df: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for all parts of a key. Each task keeps k hashes of a key before the shuffle and after it."""
    hashes = df.select(*keys, F.explode(sketch).alias("__hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("__hash"))
    kept = hashes.withColumn("__rank", rank).where(F.col("__rank") <= k)
    found = kept.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(sketch))
    return df.select(*keys).distinct().join(found, keys, "left").withColumn(sketch, F.coalesce(sketch, F.array().cast(NO_HASHES)))


def as_text(sketch: Column) -> Column:
    """The sketch as a string: base64 of its hashes, 8 bytes each."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""))), "\r\n", "")


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted `cuts` are not above `key`: looked up in blocks of about their square root."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    array = lambda of: F.split(F.lit(",".join(map(str, of))), ",").cast(NO_HASHES)
    upto = lambda some: F.size(F.filter(some, lambda c: c <= key))
    block = F.greatest(upto(array(cuts[::step])) - 1, F.lit(0))
    return block * step + upto(F.slice(array(cuts), block * step + 1, F.lit(step)))


def with_next(df: DataFrame, key: str, columns: list[str], prefix: str = "next_") -> tuple[DataFrame, Window]:
    """Rows ordered by `key` in ranges, ready for lead(): (the rows with __range and __guest, the window).

    Every range holds a guest copy of the first rows of the following one (the last range: of the first), so that no
    row needs another range; whoever uses the window drops the guests (`__guest`) after it. Ranges are quantiles of the
    key: their number follows the row count, and the driver gets two numbers for each.
    """
    rows = df.count()
    ranges = max(1, min(MAX_RANGES, rows // RANGE_ROWS))
    cuts = df.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    cuts = sorted(set(cuts or []))
    own = df.select(key, *columns, F.coalesce(_range_of(F.col(key), cuts), F.lit(0)).alias("__range"))
    firsts = sorted((r["__range"], r["first"]) for r in own.groupBy("__range").agg(F.min(key).alias("first")).collect())
    before = {r: firsts[i - 1][0] for i, (r, _) in enumerate(firsts)}
    size = len(cuts) + 1
    first_of = dict(firsts)
    text = lambda of: F.split(F.lit(",".join("" if of.get(i) is None else str(of[i]) for i in range(size))), ",")
    first = F.nullif(F.get(text(first_of), F.col("__range")), F.lit("")).try_cast("bigint")
    to = F.nullif(F.get(text(before), F.col("__range")), F.lit("")).try_cast("int")
    home = F.struct(F.col("__range").alias("at"), F.lit(0).alias("guest"))
    places = F.when(F.col(key).eqNullSafe(first), F.array(home, F.struct(to.alias("at"), F.lit(1).alias("guest")))).otherwise(F.array(home))
    dealt = own.withColumn("__place", F.explode(places)).select(key, *columns, F.col("__place.at").alias("__range"), F.col("__place.guest").alias("__guest"))
    return dealt, Window.partitionBy("__range").orderBy("__guest", F.col(key).asc_nulls_first(), *[F.xxhash64(c) for c in columns])


def op2_fingerprints(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """Every document's sketch, its likeness to that of an edited text and of the next document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, order = with_next(docs, "doc_id", ["text"])
    rows = with_sketch(rows, "text", "sketch", k)
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}).where("__guest = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    rows = with_sketch(rows, "edited", "edited_sketch", k)
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )

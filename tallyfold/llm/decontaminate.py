"""Benchmark decontamination by winnowing.

Of every `w` consecutive k-gram hashes the smallest (the rightmost of equals) is kept as a fingerprint. Two texts that
share a run of k + w - 1 words keep the same fingerprint in it, so every shared run of at least that length meets in the
index; the hit is then extended word by word to both sides, on the words themselves, and kept if it is long enough.
With window 10 the operator takes k = 5 and w = 6. Items of m < 10 words are one window: for each such m that occurs,
all m-grams are kept (k = m, w = 1), which is the same guarantee for shorter runs.

Words: A-Z lower-cased, then runs of characters other than U+0000-2F, 3A-60, 7B-7F. The classes are those of single
bytes in UTF-8, so texts are handled as blocks of bytes with numpy, never word by word.

The index of the benchmark is broadcast in blocks of at most `block_bytes` of item text, so its size is bounded; a
larger benchmark makes more blocks, and each block is one more pass over the words, without any shuffle.

Defined cases: a null or empty text has no words, no hits and is not contaminated; an item without words is ignored;
repeated items with the same id count once; item ids are compared as strings; repeated rows are handled alike; an empty
documents or benchmark table works; output columns replace columns of the input of the same name.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, lean, text_runs

WINDOW = 10
K = 5
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 16_000_000
#: Bytes of documents that are handled at once (single longer texts are taken whole).
CHUNK_BYTES = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_NONE = np.uint64(2**64 - 1)


class Words:
    """The words of several texts: bytes, bounds, hashes and the text each belongs to.

    `is_word` says which bytes make words; `gap`, which is not one of them, is put between texts.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray = _IS_WORD, gap: bytes = b"\0"):
        joined = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
        self.bytes = _LOWER[joined]
        self.within = is_word[self.bytes]
        edge = np.flatnonzero(np.diff(self.within.view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edge[0::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.text = np.searchsorted(ends, self.start, side="right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        size = self.end - self.start
        if not len(size):
            return np.zeros(0, np.uint64)
        power = np.ones(int(size.max()), np.uint64)
        power[1:] = _STEP
        power = np.multiply.accumulate(power)
        at = np.cumsum(size) - size
        offset = np.arange(int(size.sum())) - np.repeat(at, size)
        value = _TABLE[self.bytes[self.within]] * power[offset]
        out = np.add.reduceat(value, at)
        return (out ^ (out >> np.uint64(29))) * _MIX

    def word(self, i: int) -> bytes:
        return self.bytes[self.start[i] : self.end[i]].tobytes()

    def grams(self, k: int) -> np.ndarray:
        """Hashes of the k-grams from each word on; those that leave their text are all ones."""
        n = len(self.hash)
        out = np.full(n, _NONE)
        if n >= k:
            value = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                value = value * _STEP + self.hash[j : n - k + 1 + j]
            value = (value ^ (value >> np.uint64(31))) * _MIX
            value ^= value >> np.uint64(28)
            inside = self.text[: n - k + 1] == self.text[k - 1 :]
            out[: n - k + 1] = np.where(inside, np.minimum(value, _NONE - np.uint64(1)), _NONE)
        return out

    def winnowed(self, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the fingerprints."""
        grams = self.grams(k)
        if w == 1:
            at = np.flatnonzero(grams != _NONE)
            return at, grams[at]
        n = len(grams) - (w - 1)
        if n <= 0 or len(grams) < k + w - 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least, where = grams[:n].copy(), np.zeros(n, np.int8)
        for j in range(1, w):
            other = grams[j : n + j]
            lower = other <= least
            where[lower] = j
            np.minimum(least, other, out=least)
        inside = np.zeros(n, bool)
        last = n - k + 1
        if last > 0:
            inside[:last] = self.text[:last] == self.text[w + k - 2 : w + k - 2 + last]
        at = np.unique((np.arange(n) + where)[inside])
        return at, grams[at]


class Index:
    """Fingerprints of benchmark items, by length of the k-gram."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, k: int):
        self.window, self.k = window, k
        words = Words([t for _, t in items])
        self.names = [name for name, _ in items]
        self.items = [[words.word(f + i) for i in range(n)] for f, n in zip(words.first.tolist(), words.count.tolist(), strict=True)]
        self.kinds: dict[int, tuple[int, np.ndarray, dict[int, list[tuple[int, int]]]]] = {}
        for size in sorted({min(len(x), window) for x in self.items} - {0}):
            gram, w = (k, window - k + 1) if size == window else (size, 1)
            at, hashes = words.winnowed(gram, w)
            found: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for i, h in zip(at.tolist(), hashes.tolist(), strict=True):
                item = int(words.text[i])
                if min(len(self.items[item]), window) == size:
                    found[h].append((item, i - int(words.first[item])))
            self.kinds[size] = (gram, w, np.array(sorted(found), np.uint64), dict(found))

    def hits(self, words: Words) -> list[list[tuple[str, int, int]]]:
        """For each text (item, first word, word after the last) of every maximal shared run that is long enough."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in words.count]
        for size, (gram, w, known, places) in self.kinds.items():
            at, hashes = words.winnowed(gram, w)
            if not len(at) or not len(known):
                continue
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            reached: dict[tuple[int, int, int], int] = {}
            for i, h in zip(at[(hit := known[near] == hashes)].tolist(), hashes[hit].tolist(), strict=True):
                text = int(words.text[i])
                low = int(words.first[text])
                high = low + int(words.count[text])
                for item, j in places[h]:
                    if reached.get((text, item, i - j), -1) >= i + gram:
                        continue  # within a run that is known already
                    own = self.items[item]
                    a, b = i, i
                    while b < high and j + b - i < len(own) and words.word(b) == own[j + b - i]:
                        b += 1
                    if b == i:
                        continue
                    while a > low and j + a - i > 0 and words.word(a - 1) == own[j + a - i - 1]:
                        a -= 1
                    reached[text, item, i - j] = b
                    if b - a >= size:
                        out[text].append((self.names[item], a - low, b - low))
        return out


def _summary(spans: list[tuple[str, int, int]]) -> tuple[int, list[str]]:
    """(words in any span, item ids sorted as strings)."""
    hit = reach = 0
    for a, b in sorted((a, b) for _, a, b in spans):
        hit += max(0, b - max(a, reach))
        reach = max(reach, b)
    return hit, sorted({name for name, _, _ in spans})


SPAN = T.ArrayType(T.StructType([T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", SPAN)]
_SPAN_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, k: int, block_bytes: int) -> Iterator[Index]:
    """The benchmark's index in blocks; the driver holds one block of texts at a time."""
    block, total = [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text).cast("string")).where(F.col(text).isNotNull())
    for name, words in rows.toLocalIterator():
        raw = words.encode()
        if block and total + len(raw) > block_bytes:
            yield Index(block, window, k)
            block, total = [], 0
        block.append(("null" if name is None else name, raw))
        total += len(raw)
    yield Index(block, window, k)


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """`docs` (columns `keep`, all by default) with n_words, n_hit and spans (item_id, start, end in words)."""
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and the window")
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in ("n_words", "n_hit", "spans")]
    own = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + ADDED)
    with_text = T.StructType([*schema.fields, T.StructField("__text", T.StringType())])
    blocks = _blocks(benchmark, item, item_text, window, k, block_bytes)
    index, first = next(blocks), True
    while index is not None:
        following = next(blocks, None)
        last = following is None
        own = own.mapInArrow(_matcher(Shared(docs.sparkSession, index), keep, first, last), schema if last else with_text)
        index, first = following, False
    return own


def _matcher(index, keep: list[str], first: bool, last: bool):
    """A pass over the documents against one block; `first` has no spans of earlier blocks, `last` drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_runs(batch.column(batch.schema.get_field_index("__text")), CHUNK_BYTES):
                words = Words(texts)
                spans = index.value.hits(words)
                rows = batch.slice(a, b - a)
                if not first:
                    before = rows.column(rows.schema.get_field_index("spans")).to_pylist()
                    spans = [[(x["item_id"], x["start"], x["end"]) for x in old] + new for old, new in zip(before, spans, strict=True)]
                hit = [_summary(x)[0] for x in spans]
                columns = [rows.column(rows.schema.get_field_index(c)) for c in keep]
                columns += [pa.array(words.count, pa.int64()), pa.array(hit, pa.int64())]
                columns.append(pa.array([[{"item_id": n, "start": s, "end": e} for n, s, e in x] for x in spans], _SPAN_ARROW))
                names = [*keep, "n_words", "n_hit", "spans"]
                if not last:
                    columns.append(rows.column(rows.schema.get_field_index("__text")))
                    names.append("__text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return lean(run)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    return find_hits(docs, benchmark, **options).where("n_hit = 0").select(*docs.columns)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against the benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return find_hits(docs, benchmark, keep=["doc_id"]).select(
        "doc_id", "n_words", "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, list[str]]:
    """(words, words hit, items) by trying every window at every place; for tests."""
    import regex

    split = lambda t: regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    own, hit, found = split(text), set(), set()
    for name, t in items:
        other = split(t)
        size = min(window, len(other))
        for j in range(len(other) - size + 1 if size else 0):
            for i in range(len(own) - size + 1):
                if own[i : i + size] == other[j : j + size]:
                    hit.update(range(i, i + size))
                    found.add(name)
    return len(own), len(hit), sorted(found)


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)
), h AS (SELECT doc_id, item_id, i, dw.m FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS s FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

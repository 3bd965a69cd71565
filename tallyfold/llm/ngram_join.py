"""N-gram Jaccard join: universe-partition pigeonhole.

A document is the set of its distinct 3-word shingles; two link when their Jaccard similarity reaches a threshold (0.9).
Sets of sizes s and t can only link if they differ in at most H = floor((s + t) (1 - j) / (1 + j)) shingles. The universe
of shingles is hashed into segments, by size band; with budgets v of 0, 1 or 2 for the segments, whose sum exceeds H by a
reserve, two linked sets have matching segments i, in which they differ by less than v_i, of a total budget above that
reserve: the same segment subset where v is 1, at most one shingle apart where v is 2. A set is therefore indexed under
its segment subsets, and for segments with v = 2 also under their one-deletion neighbourhoods. Budgets start at 1 each;
segments whose subsets are shared by so many sets that their pairs cost more than another segment's deletions get 0, and
that other segment gets 2 (allocation by cost, from counts over all sets).

Signatures that many sets share for nothing are left out, and the reserve pays for them: the empty subset; signatures in
a bucket that holds more than 1 in HEAVY of all rows (a fixed number of counters, over all sets); and signatures of more
than CROWD sets that are still in several components. Whether one is left out depends on the signature alone. A linked
pair is only missed if all its matching segments are such, and then both sets have lost more budget than the reserve; so
the sets that lost more are indexed again, with another division of the universe, and in the last of LEVELS divisions
with all their signatures. No pair is lost, and no group is larger than a fixed share of the rows, or than CROWD, before
that last division.

Candidates never become all pairs of a group. Equal sets are one class from the start. In a round of stars every class
is checked against the first of each of its groups only; components of these links are then known, and only classes of
different components that still share a group are paired. Sizes and odd sketches (bits that differ are a lower bound of
the sets' difference), at last sketches of about one bit a shingle, thin out the candidates before any text moves; the
rest is verified on the words themselves, with one copy of the smaller document's text for up to PARTS parts of its star.

Defined cases: a null text, or one without words, has an empty set and links with nothing; texts of one or two words have
one shingle, the whole sequence; repeated rows are equal sets; a row without a key gets the component of an equal set
with a key, else null, and links through it only; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, Tables, cut, few, hot_join, lean, text_runs
from .components import components
from .decontaminate import Words

N = 3
#: The threshold as a percentage.
PERCENT = 90
#: Largest over smallest size of a band, about.
BAND = 1.25
SKETCH_WORDS = 8
CHUNK_BYTES = 500_000
#: One indexed row costs about as much as so many candidate pairs.
ROW_COST = 2.0
#: Sets of more shingles have a second sketch of at least a bit a shingle.
WIDE = 1_000
#: Counters of signatures, and the share of all rows (1 in HEAVY) above which a counter's signatures are left out.
COUNTERS, HEAVY = 8_192, 4_096
#: Classes of a group that may be paired before the last division of the universe.
CROWD = 64
LEVELS = 3
#: Signatures of a class that travel with each of them, 4 bytes each, by which its pairs are made once; a class with more goes without.
SIGNATURES = 512
#: Parts that share a star's centre in verification.
PARTS = 32

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mix(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * by
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(text of each distinct shingle, its hash), by text."""
    words = Words(texts, _IS_WORD, b"\n")
    text, grams = words.text, words.grams(n)
    inside = grams != np.uint64(2**64 - 1)
    text, grams = text[inside], grams[inside]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        whole = np.array([words.hash[f : f + c].dot(_B ** np.arange(1, c + 1, dtype=np.uint64)) + np.uint64(c) for f, c in zip(words.first[short], words.count[short], strict=True)], np.uint64)
        text, grams = np.concatenate([text, short]), np.concatenate([grams, _mix(whole, _A)])
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])
    return text[new], grams[new]


def _sums(key: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Sums modulo 2**64 of `value` by `key`."""
    low = np.bincount(key, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size).astype(np.uint64)
    high = np.bincount(key, (value >> np.uint64(32)).astype(np.float64), size)
    return low + ((high.astype(np.uint64) & np.uint64(0xFFFFFFFF)) << np.uint64(32))


class Bands:
    """Size bands, their difference bounds and budgets."""

    def __init__(self, percent: int = PERCENT, ratio: float = BAND):
        self.percent, self.low = percent, [1]
        self.ratio = ratio
        #: Budgets of the segments of bands where they are not all 1.
        self.budgets: dict[int, np.ndarray] = {}

    def _grow(self, size: int) -> None:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * self.ratio)))

    def of(self, size: int) -> list[int]:
        """The bands in which a set of `size` can be the larger or the smaller of a linked pair."""
        self._grow(size * 100 // self.percent + 1)
        own = int(np.searchsorted(self.low, size, side="right")) - 1
        out = [own]
        while 100 * size >= self.percent * self.low[out[-1] + 1]:
            out.append(out[-1] + 1)
            self._grow(self.low[out[-1]] + 1)
        return out

    def difference(self, band: int) -> int:
        """The most shingles in which two linked sets differ when the larger is in `band`."""
        self._grow(self.low[band] + 1)
        return 2 * (self.low[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)

    def reserve(self, band: int) -> int:
        """What the budgets of matching segments add up to, less one."""
        return 1 + self.difference(band) // 8

    def budget(self, band: int) -> np.ndarray:
        if band in self.budgets:
            return self.budgets[band]
        return np.ones(self.difference(band) + 1 + self.reserve(band), np.int8)


def _counter(sig: np.ndarray) -> np.ndarray:
    return (sig >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def signatures(text: np.ndarray, grams: np.ndarray, sizes: np.ndarray, bands: Bands, level: int = 0, heavy: np.ndarray | None = None, last: bool = True, unsafe: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(band, text, place, signature) rows of all sets, band by band; place has segment, budget and reserve left, see _PLACE.

    `level` chooses the division of the universe, `heavy` marks counters whose signatures are left out. Texts that lose
    more than the reserve are marked in `unsafe`; in the `last` division they have all their signatures.
    """
    members: dict[int, list[int]] = defaultdict(list)
    for size in np.unique(sizes[sizes > 0]).tolist():
        for band in bands.of(size):
            if bands.difference(band) > 0:
                members[band].append(size)
    second = _mix(grams, _B)
    divided = grams if level == 0 else _mix(grams + np.uint64(level), _A)
    for band, own in members.items():
        chosen = np.isin(sizes, own)
        budget = bands.budget(band)
        m, total = len(budget), int(chosen.sum())
        place = np.cumsum(chosen) - 1
        rows = np.flatnonzero(chosen[text])
        segment = ((divided[rows] >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        key = place[text[rows]] * m + segment
        held, sums = np.bincount(key, minlength=total * m), _sums(key, second[rows], total * m)
        salt = _mix(np.arange(m, dtype=np.uint64) + np.uint64((band << 32) + (level << 48)), _A)
        keys = np.flatnonzero(np.tile(budget > 0, total))
        sig, left_out = _mix(sums[keys] + salt[keys % m], _A), held[keys] == 0
        if (budget == 2).any():
            double = budget[segment] == 2
            at = key[double]
            keys = np.concatenate([keys, at])
            sig = np.concatenate([sig, _mix(sums[at] - second[rows[double]] + salt[at % m], _A)])
            left_out = np.concatenate([left_out, held[at] == 1])
        if heavy is not None:
            left_out |= heavy[_counter(sig)]
        lost = np.zeros(total * m, bool)
        lost[keys[left_out]] = True
        room = bands.reserve(band) - (lost.reshape(total, m) * budget).sum(1)
        if unsafe is not None:
            unsafe[np.flatnonzero(chosen)[room < 0]] = True
        used = ~left_out | (last & (room < 0)[keys // m])
        keys, sig = keys[used], sig[used]
        seg = keys % m
        yield band, np.flatnonzero(chosen)[keys // m], _place(band, seg, budget[seg], np.maximum(room[keys // m], 0)), sig


#: Bits of a place: band, budget, segment, reserve left.
_PLACE = {"band": (44, 12), "v": (42, 2), "segment": (20, 22), "room": (0, 20)}


def _place(band: int, segment: np.ndarray, v: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Exact for sets of up to 4 million segments, some 18 million shingles; larger ones raise."""
    if len(segment) and int(segment.max()) >> 22:
        raise ValueError("a document has more than 4 million segments")
    return (np.int64(band) << 44) | (v.astype(np.int64) << 42) | (segment.astype(np.int64) << 20) | np.minimum(room, (1 << 20) - 1).astype(np.int64)


def _placed(name: str):
    low, bits = _PLACE[name]
    return F.shiftrightunsigned("place", low).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(name)


def allocate(bands: Bands, pairs: dict[int, dict[int, float]], sets: dict[int, tuple[int, int]]) -> Bands:
    """Budgets by cost. `pairs`: candidate pairs by band and segment; `sets`: (sets, shingles) by band.

    The costliest segment is given up, for the deletions of the cheapest, as long as that is cheaper.
    """
    for band, by_segment in pairs.items():
        budget = np.ones(len(bands.budget(band)), np.int8)
        n, shingles = sets[band]
        deletions = ROW_COST * shingles / len(budget)
        order = sorted(range(len(budget)), key=lambda i: -by_segment.get(i, 0.0))
        low, high = 0, len(order) - 1
        while low < high and by_segment.get(order[low], 0.0) > deletions + by_segment.get(order[high], 0.0):
            budget[order[low]], budget[order[high]] = 0, 2
            low, high = low + 1, high - 1
        if (budget != 1).any():
            bands.budgets[band] = budget
    return bands


_LONGS = ["doc", "n", "k1", "k2"] + [f"s{i}" for i in range(SKETCH_WORDS)]
SETS = T.StructType([T.StructField(c, T.LongType()) for c in _LONGS] + [T.StructField("wide", T.BinaryType()), T.StructField("counts", T.ArrayType(T.LongType()))])
_SETS_ARROW = pa.schema([(c, pa.int64()) for c in _LONGS] + [("wide", pa.binary()), ("counts", pa.list_(pa.int64()))])
#: Sets that a task remembers having indexed; a copy beyond them is indexed again, which does no harm.
SEEN = 1_000_000


class _New:
    """Says which sets a task has not met before."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        new = np.zeros(len(keys), bool)
        for i, k in enumerate(keys.tolist()):
            if k not in self.seen:
                new[i] = True
                self.seen.add(k)
        if len(self.seen) > SEEN:
            self.seen.clear()
        return new


def wide_sketch(grams: np.ndarray) -> bytes:
    """The odd sketch of a set in the least power of two of bits that is not below its size."""
    bits = 1 << max(6, int(len(grams) - 1).bit_length())
    odd = np.bincount((_mix(grams, _B) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_apart(one: bytes, two: bytes) -> int:
    """A lower bound of the difference of two sets by their sketches; the longer one is folded."""
    a, b = sorted((np.frombuffer(x, np.uint8) for x in (one, two)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _describe(n: int, bands: Shared):
    """(doc, set size, two hashes of the set, odd sketches) of every document; and a row of counted signatures a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, counts = _New(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for a, b, texts in text_runs(batch.column(1), CHUNK_BYTES):
                text, grams = shingle_sets(texts, n)
                size = b - a
                bits = SKETCH_WORDS * 64
                odd = np.bincount(text * bits + (_mix(grams, _C) & np.uint64(bits - 1)).astype(np.int64), minlength=size * bits) & 1
                sketch = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(size, SKETCH_WORDS)
                keys = [_sums(text, _mix(grams, by), size).view(np.int64) for by in (_A, _B)]
                sizes = np.bincount(text, minlength=size)
                ends = np.cumsum(sizes)
                wide = [wide_sketch(grams[e - c : e]) if c > WIDE else None for c, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                columns = [batch.column(0).slice(a, size), pa.array(sizes), *map(pa.array, keys)]
                columns += [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_WORDS)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(wide, pa.binary()), pa.nulls(size, pa.list_(pa.int64()))], schema=_SETS_ARROW)
                used = new(keys[0])[text]
                for _, _, _, sig in signatures(text[used], grams[used], np.bincount(text[used], minlength=size), bands.value, last=False):
                    counts += np.bincount(_counter(sig), minlength=COUNTERS)
        yield pa.RecordBatch.from_pylist([{"counts": counts.tolist()}], schema=_SETS_ARROW)

    return lean(run)


def _index(bands: Shared, n: int, level: int, heavy: Shared):
    """(place, signature, k1) of the sets, and (-1, k1, k1) of unsafe ones; a set that a task meets again is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, last = _New(), level == LEVELS - 1
        row = lambda place, sig, k1: pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(sig, pa.int64()), pa.array(k1, pa.int64())], names=["place", "sig", "k1"])
        for batch in batches:
            for a, b, texts in text_runs(batch.column(1), CHUNK_BYTES):
                text, grams = shingle_sets(texts, n)
                key = _sums(text, _mix(grams, _A), b - a).view(np.int64)
                used = new(key)[text]
                text, grams = text[used], grams[used]
                sizes, unsafe = np.bincount(text, minlength=b - a), np.zeros(b - a, bool)
                for _, who, place, sig in signatures(text, grams, sizes, bands.value, level, heavy.value, last, unsafe):
                    yield row(place, sig.view(np.int64), key[who])
                if unsafe.any() and not last:
                    yield row(np.full(int(unsafe.sum()), -1), key[unsafe], key[unsafe])

    return lean(run)


def shingles_of(text: bytes | None, n: int = N) -> set[tuple[bytes, ...]]:
    """The exact set, for verification."""
    words = _WORD.findall((text or b"").translate(_LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n)), strict=False))


def _verify(percent: int, n: int):
    """Of (a, b, text of a, text of b), sorted by a or nearly so, the pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            one, two = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            links = []
            for t, u in zip(one, two, strict=True):
                if t != last:
                    last, last_set = t, shingles_of(t, n)
                other = shingles_of(u, n)
                both = len(last_set & other)
                links.append(bool(both) and 100 * both >= percent * (len(last_set) + len(other) - both))
            kept = pa.array(links)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return run


def _thin(percent: int):
    """Of (a, b, na, nb, wide sketches) those whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            kept = pa.array([u is None or v is None or wide_apart(u, v) * (100 + percent) <= (m + n) * (100 - percent) for m, n, u, v in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, percent: int, n: int, kept: Tables) -> DataFrame:
    """Of `pairs` (a, b) those that link; only the texts that occur in pairs are moved.

    A star's centre `a` is sent to PARTS parts of its star at most, so a hot centre is not one task's.
    """
    parted = cut(pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(PARTS)).alias("part")))
    centres = parted.select("a", "part").distinct()
    wanted = cut(centres.select(F.col("a").alias("doc")).unionByName(parted.select(F.col("b").alias("doc"))).distinct())
    found = docs.join(few(wanted), "doc").select("doc", "text")
    texts = kept.keep(found.groupBy("doc").agg(F.min("text").alias("text")), "texts")
    one = centres.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    two = parted.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
    return one.join(two, ["a", "part"]).select("a", "b", "text_a", "text_b").mapInArrow(_verify(percent, n), "a long, b long")


def _groups(docs: DataFrame, bands: Bands, n: int, level: int, heavy: np.ndarray | None) -> DataFrame:
    """(place, sig, k1, head, before, members) of the signatures that several sets share; unsafe sets have the place -1.

    `before`: sets of the group before this one, the first of which is `head`. One shuffle by signature; duplicates and
    lonely signatures go in passing over the sorted rows.
    """
    spark = docs.sparkSession
    rows = docs.mapInArrow(_index(Shared(spark, bands), n, level, Shared(spark, heavy)), "place long, sig long, k1 long")
    same, order = Window.partitionBy("sig"), Window.partitionBy("sig").orderBy("k1")
    own = rows.repartition("sig").withColumn("last", F.lag("k1").over(order)).where("last is null or last <> k1 or place < 0")
    near = own.withColumns({"before": F.row_number().over(order) - 1, "next": F.lead("k1").over(order), "head": F.first("k1").over(order)})
    near = near.where("before > 0 or next is not null or place < 0")
    return cut(near.withColumn("members", F.count("*").over(same)).select("place", "sig", "k1", "head", "before", "members"))


def _close(one: str, two: str, percent: int):
    """Filters that linked sets pass: sizes, and odd sketches that differ in few bits."""
    a, b = F.col(f"{one}.n"), F.col(f"{two}.n")
    bits = sum((F.bit_count(F.col(f"{one}.s{i}").bitwiseXOR(F.col(f"{two}.s{i}"))) for i in range(1, SKETCH_WORDS)), F.bit_count(F.col(f"{one}.s0").bitwiseXOR(F.col(f"{two}.s0"))))
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (bits * (100 + percent) <= (a + b) * (100 - percent))


class _Join:
    """The steps of link() and what they share."""

    def __init__(self, docs: DataFrame, key: str, text: str, n: int, percent: int):
        self.n, self.percent, self.kept = n, percent, Tables(docs.sparkSession)
        self.docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
        self.bands = Bands(percent)
        described = self.kept.keep(self.docs.mapInArrow(_describe(n, Shared(docs.sparkSession, self.bands)), SETS), "sets")
        self.sets = described.where("n is not null").drop("counts")
        counted = described.where("n is null").select(F.posexplode("counts").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("c")).collect()
        rows = np.zeros(COUNTERS)
        rows[[r.i for r in counted]] = [r.c for r in counted]
        self.heavy = rows > max(float(HEAVY), rows.sum() / HEAVY)
        sketch = [f"s{i}" for i in range(SKETCH_WORDS)]
        self.node = F.struct("rep", "n", *sketch)
        grouped = self.sets.where("n > 0").groupBy("k1", "k2", "n")
        self.classes = cut(grouped.agg(F.min("doc").alias("rep"), F.count("*").alias("copies"), *[F.max(c).alias(c) for c in sketch]))
        self.links = self.label = self.tried = None

    def allocated(self, groups: DataFrame) -> bool:
        """Sets budgets by cost; only segments that cost more than another's deletions are looked at."""
        low = F.array(*[F.lit(x) for x in self._lows()])
        own = F.size(F.filter(low, lambda x: x <= F.col("n"))) - 1
        totals: dict[int, tuple[int, int]] = defaultdict(lambda: (0, 0))
        for r in self.classes.groupBy(own.alias("band")).agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect():
            for band in self.bands.of(self.bands.low[r.band]):
                totals[band] = totals[band][0] + r.c, totals[band][1] + r.n
        least = [(band, ROW_COST * n / len(self.bands.budget(band))) for band, (_, n) in totals.items() if self.bands.difference(band)]
        if not least:
            return False
        limits = F.broadcast(groups.sparkSession.createDataFrame(least, "band int, least double"))  # a row a band
        costly = groups.where("place >= 0").groupBy(_placed("band"), _placed("segment")).agg(F.sum("before").alias("pairs"))
        costs: dict[int, dict[int, float]] = defaultdict(dict)
        for r in costly.join(limits, "band").where("pairs > least").collect():
            costs[r.band][r.segment] = float(r.pairs)
        return bool(allocate(self.bands, costs, totals).budgets)

    def _lows(self) -> list[int]:
        most = self.classes.agg(F.max("n")).first()[0] or 1
        self.bands.of(most)
        return self.bands.low

    def check(self, candidates: DataFrame) -> None:
        """Verifies pairs of classes (x, y) that pass _close(), adds their links and works out the components."""
        near = candidates.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"), F.col("x.n").alias("m"), F.col("y.n").alias("n")).distinct()
        if self.tried is not None:
            near = near.join(self.tried, ["a", "b"], "left_anti")
        near = cut(near)
        wide = self.sets.where(f"n > {WIDE}").select("doc", "wide")
        small, large = near.where(f"m <= {WIDE} or n <= {WIDE}").select("a", "b"), near.where(f"m > {WIDE} and n > {WIDE}")
        large = large.join(wide.select(F.col("doc").alias("a"), F.col("wide").alias("u")), "a").join(wide.select(F.col("doc").alias("b"), F.col("wide").alias("v")), "b")
        large = large.select("a", "b", "m", "n", "u", "v").mapInArrow(_thin(self.percent), "a long, b long").distinct()
        pairs = cut(small.unionByName(large))
        self.tried = near.select("a", "b") if self.tried is None else self.tried.unionByName(near.select("a", "b"))
        if pairs.isEmpty():
            return
        found = cut(verified(pairs, self.docs, self.percent, self.n, self.kept))
        self.links = found if self.links is None else self.links.unionByName(found)
        self.label = cut(components(self.links))

    def sides(self, pairs: DataFrame) -> DataFrame:
        """(x, y): classes of pairs of set hashes (k, l) that may link."""
        one = self.classes.where("rep is not null").select(F.col("k1").alias("k"), self.node.alias("x"))
        two = one.select(F.col("k").alias("l"), F.col("x").alias("y"))
        return pairs.join(one, "k").join(two, "l").select("x", "y").where(F.expr("x.rep <> y.rep") & _close("x", "y", self.percent))

    def met(self, groups: DataFrame) -> DataFrame:
        """(x, y): classes of different components that share a signature and may link.

        Sizes and sketches travel with the signatures and are part of the join, so that no pair is made to be dropped.
        So do all 32-bit keys of a class, up to SIGNATURES of them: a pair is made by the least key it shares only. Keys
        that several signatures have are shared ones, too, so no pair is lost.
        """
        narrow = [c for c in self.classes.columns if c not in ("k1", "k2", "copies")]
        own = cut(groups.select(F.hash("sig").alias("key"), "label", "rep").distinct())
        keys = own.groupBy("rep").agg(F.count("*").alias("c"), F.collect_list("key").alias("keys"))
        keys = keys.select("rep", F.when(F.col("c") <= SIGNATURES, F.col("keys")).alias("keys"))
        rows = cut(own.join(keys, "rep").join(self.classes.where("rep is not null").select(*narrow), "rep"))
        x, y = rows.alias("x"), rows.alias("y")
        least = F.coalesce(F.array_min(F.array_intersect("x.keys", "y.keys")), "x.key")
        both = x.join(y, (F.col("x.key") == F.col("y.key")) & F.expr("x.label < y.label") & _close("x", "y", self.percent) & (least == F.col("x.key")))
        return both.select(F.struct("x.rep", "x.n").alias("x"), F.struct("y.rep", "y.n").alias("y"))

    def mixed(self, groups: DataFrame) -> DataFrame:
        """(place, sig, k1, rep, label, members) of the groups that hold several components."""
        own = self.classes.select("k1", "rep", F.col("rep").alias("label"))
        if self.label is not None:
            own = own.join(self.label.select(F.col("node").alias("rep"), "component"), "rep", "left").select("k1", "rep", F.coalesce("component", "label").alias("label"))
        known = groups.where("place >= 0").join(own, "k1")
        bounds = known.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return cut(known.join(bounds, "sig").select("place", "sig", "k1", "rep", "label", "members"))

    def run(self) -> None:
        docs, left = self.docs, []
        for level in range(LEVELS):
            heavy = self.heavy if level == 0 else None
            groups = _groups(docs, self.bands, self.n, level, heavy)
            if level == 0 and self.allocated(groups):
                groups = _groups(docs, self.bands, self.n, level, heavy)
            self.check(self.sides(groups.where("head <> k1 and place >= 0").select(F.col("head").alias("k"), F.col("k1").alias("l")).distinct()))
            mixed = self.mixed(groups)
            if level == LEVELS - 1:
                left.append(mixed)
                break
            left.append(mixed.where(f"members <= {CROWD}"))
            crowded = mixed.where(f"members > {CROWD}").select("k1", _placed("band"), _placed("segment"), _placed("v"), _placed("room")).distinct()
            crowded = crowded.groupBy("k1", "band").agg(F.sum("v").alias("v"), F.min("room").alias("room")).where("v > room").select("k1")
            again = cut(crowded.unionByName(groups.where("place < 0").select("k1")).distinct())
            reps = cut(again.join(self.classes.select("k1", "rep"), "k1").select(F.col("rep").alias("doc")).distinct())
            if reps.isEmpty():
                break
            docs = self.docs.join(few(reps), "doc").select("doc", "text")
        # the components of all divisions are known by now
        self.check(self.met(self.mixed(reduce(DataFrame.unionByName, left).select("place", "sig", "k1", "members"))))


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(`key`, n_shingles, component_id) of every document; `key` is a whole number."""
    join = _Join(docs, key, text, n, percent)
    join.run()
    placed = join.classes.select("k1", "k2", "n", "copies", F.col("rep").alias("component_id"))
    if join.label is not None:
        placed = placed.join(join.label.select(F.col("node").alias("component_id"), "component"), "component_id", "left")
        placed = placed.select("k1", "k2", "n", "copies", F.coalesce("component", "component_id").alias("component_id"))
    out = cut(hot_join(join.sets.select("doc", "n", "k1", "k2"), placed, ["k1", "k2", "n"], "copies"))
    join.kept.drop()
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """The document of the smallest key of every component, with its own columns; documents without a key stay."""
    linked = link(docs.where(F.col(key).isNotNull()), key, text, n, percent)
    gone = cut(linked.where(F.col("component_id") != F.col(key)).select(F.col(key).alias("__gone")).distinct())
    return docs.join(few(gone), docs[key] == F.col("__gone"), "left_anti")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of links at 0.9 over 3-word shingles."""
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP5_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r.c), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id, n.n
"""

"""Packing: Karmarkar-Karp multiway differencing of documents into windows of a fixed number of tokens.

A document longer than a window fills whole windows of its own first. What is left of each document is one piece; the
pieces of a block (about `BLOCK_TOKENS` tokens of one task's documents) are dealt out by multiway differencing: every
piece starts as a partial partition with one load; the two partial partitions of the widest spread are merged, the
largest load of one with the smallest of the other, until one is left. If its largest window exceeds the capacity, the
number of windows rises and the block is dealt out anew. Blocks are bounded, so no task holds more than one.

A task tokenizes its documents, packs them and emits the pieces: there is no shuffle, and a lost task is run again on
its own. Words between ASCII white space are tokenized once per worker and block (the tokenizer's pieces never cross white
space), at most twice `CACHE_WORDS` are remembered, and only while workers pack.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; very long
texts are cut at window bounds only; an empty table gives no pieces; only the named columns are read.
"""

from __future__ import annotations

import heapq
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, lean

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 1_250_000
BLOCK_PIECES = 4_000
#: Words that a worker remembers, in each of two generations.
CACHE_WORDS = 150_000
CHUNK_BYTES = 4_000_000
#: Words whose ids are laid out at once.
RUN_WORDS = 1 << 16


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The indices of `sizes` in each of `windows` parts of nearly equal sums."""
    n = len(sizes)
    if windows <= 1 or n <= 1:
        return [list(range(n))] + [[] for _ in range(windows - 1)]
    left, right = [-1] * n, [-1] * n
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)

    def taken(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in made:
            return made.pop(i)
        loads, slots = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        loads[-1], slots[-1] = sizes[i], i
        return loads, slots

    label = n
    while len(heap) > 1:
        (a, a_slots), (b, b_slots) = taken(heapq.heappop(heap)[1]), taken(heapq.heappop(heap)[1])
        loads, other = a + b[::-1], b_slots[::-1]
        slots = np.where(a_slots < 0, other, a_slots)
        for j in np.flatnonzero((a_slots >= 0) & (other >= 0)).tolist():
            left.append(int(a_slots[j]))
            right.append(int(other[j]))
            slots[j] = len(left) - 1
        order = np.argsort(loads, kind="stable")
        loads, slots = loads[order], slots[order]
        label += 1
        made[label] = loads, slots
        heapq.heappush(heap, (int(loads[0] - loads[-1]), label))
    out = []
    for root in taken(heap[0][1])[1].tolist():
        found, stack = [], [root] if root >= 0 else []
        while stack:
            i = stack.pop()
            if left[i] < 0:
                found.append(i)
            else:
                stack += left[i], right[i]
        out.append(sorted(found))
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`: as few as differencing needs."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece is larger than a window")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, windows)
        over = max(sum(sizes[i] for i in p) for p in parts) - capacity
        if over <= 0:
            return [p for p in parts if p]
        windows += max(1, windows * over // capacity)


class WordEncoder:
    """Token ids of texts by a tokenizer whose pieces never cross white space (lower-casing word-level BPE).

    A word of letters only, perhaps with one mark behind, goes straight to the BPE model; anything else goes through
    the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: Ids as bytes of unsigned 32-bit numbers, of words met since the last change of generation and in the one before.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        #: Bytes as the characters that a byte-level model writes for them.
        self.bytes = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}

    def _tokenized(self, unit: str) -> bytes:
        spelt = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.bytes)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _known(self, word: str) -> bytes | None:
        if (ids := self.words.get(word)) is None and (ids := self.older.get(word)) is not None:
            self._keep(word, ids)
        return ids

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(self.words) >= CACHE_WORDS:
            self.words, self.older = {}, self.words
        self.words[word] = ids
        return ids

    def _unit(self, low: str) -> bytes:
        """Ids of lower-case letters, which are a word of their own unless they change once more when lower-cased."""
        if low.lower() != low:
            return self._tokenized(low)
        return ids if (ids := self._known(low)) is not None else self._keep(low, self._tokenized(low))

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self._tokenized(mark)
        return self.marks[mark]

    def word(self, word: str) -> bytes:
        if not word:
            return b""
        if (ids := self._known(word)) is None:
            body, mark = (word[:-1], word[-1]) if word[-1] in ".,;:!?" else (word, "")
            if body.isalpha() and "Σ" not in body and unicodedata.is_normalized("NFC", body) and (low := body.lower()).isalpha() and (low.isascii() or unicodedata.is_normalized("NFC", low)):
                ids = self._unit(low) + (self._mark(mark) if mark else b"")
            else:
                ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            self._keep(word, ids)
        return ids

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds of each text); every text is followed by `end`."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = split.flatten().dictionary_encode()
        known = [self.words.get(w) or self.word(w) for w in coded.dictionary.to_pylist()]
        size = np.array([len(x) for x in known], np.int64) // 4
        pool = np.frombuffer(b"".join([*known, array("I", [end]).tobytes()]), np.uint32)
        start = np.cumsum(size) - size
        bounds = split.offsets.to_numpy()
        bounds = bounds - bounds[0]
        # one more word, the end id, behind each text
        size, start = np.append(size, 1), np.append(start, len(pool) - 1)
        code = np.insert(coded.indices.to_numpy(zero_copy_only=False), bounds[1:], len(size) - 1)
        del split, coded, known
        after = np.cumsum(size[code])
        ids = np.empty(int(after[-1]) if len(after) else 0, np.uint32)
        for at in range(0, len(code), RUN_WORDS):
            words, ends = code[at : at + RUN_WORDS], after[at : at + RUN_WORDS]
            n = size[words]
            first, last = int(ends[0] - n[0]), int(ends[-1])
            ids[first:last] = pool[np.repeat(start[words] - (ends - n), n) + np.arange(first, last)]
        return ids, np.concatenate([[0], after[bounds[1:] + np.arange(len(texts))]])


def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process, as long as it packs."""
    encoders = kept("encoders")
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


PIECE = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
]


def _pack_block(docs: list[tuple[object, np.ndarray]], capacity: int, sequence: int) -> tuple[list[tuple], int]:
    """Pieces (key, start, length, ids, doc_tokens, sequence, offset) of the documents, and the next free sequence."""
    out, rest = [], []
    for key, ids in docs:
        whole = len(ids) - len(ids) % capacity
        for at in range(0, whole, capacity):
            out.append((key, at, capacity, ids[at : at + capacity], len(ids), sequence, 0))
            sequence += 1
        if whole < len(ids):
            rest.append((key, whole, ids))
    for window in windows_of([len(ids) - at for _, at, ids in rest], capacity):
        offset = 0
        for i in window:
            key, at, ids = rest[i]
            out.append((key, at, len(ids) - at, ids[at:], len(ids), sequence, offset))
            offset += len(ids) - at
        sequence += 1
    return out, sequence


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents: `key`, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with `with_ids` the ids.

    Sequences are numbered by task and within it; they are to be padded to `capacity`.
    """
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), *PIECE] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    own = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(_packer(tokenizer, capacity, end, with_ids), schema).withColumnRenamed("key", key)


def _packer(tokenizer: str, capacity: int, end: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        block, tokens, pieces, kind = [], 0, 0, None

        def emit() -> pa.RecordBatch:
            nonlocal block, tokens, pieces, sequence
            rows, sequence = _pack_block(block, capacity, sequence)
            block, tokens, pieces = [], 0, 0
            columns = [pa.array([r[0] for r in rows], kind)]
            columns += [pa.array(x, pa.int64()) for x in ([r[1] for r in rows], [r[2] for r in rows], [zlib.crc32(r[3].astype("<u4").tobytes()) for r in rows], [r[4] for r in rows], [r[5] for r in rows], [r[6] for r in rows])]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                flat = np.concatenate([r[3] for r in rows]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(np.cumsum([0] + [r[2] for r in rows]).astype(np.int32), pa.array(flat)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kind = batch.schema.field("key").type
            texts, keys = batch.column(batch.schema.get_field_index("text")), batch.column(batch.schema.get_field_index("key")).to_pylist()
            at = 0
            step = max(1, int(len(texts) * CHUNK_BYTES / max(texts.nbytes, CHUNK_BYTES)))
            while at < len(texts):
                ids, bounds = encoder.encode(texts.slice(at, step), end)
                for i in range(len(bounds) - 1):
                    one = ids[bounds[i] : bounds[i + 1]]
                    block.append((keys[at + i], one))
                    tokens += len(one)
                    pieces += 1
                    if tokens >= BLOCK_TOKENS or pieces >= BLOCK_PIECES:
                        yield emit()
                at += step
        if block:
            yield emit()

    return lean(run, "encoders")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), with_ids=False)

"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import pickle
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.sources.store import release, scratch, shared_dir


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there, and lost executors cost nothing.

    What led to it is let go, so that the shuffle files of finished steps don't pile up on the executors' disks.
    """
    spark = df.sparkSession
    shared_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    release(spark)
    return out


def sharing(df: DataFrame, per_task: int, rows: int) -> int:
    """How many salts keep a group of `rows` rows below `per_task` rows each."""
    return max(1, -(-rows // per_task))


#: Narrow rows (some 50 bytes each in memory) that may be broadcast.
FEW_ROWS = 1_000_000
#: Keys with more than one in HOT_KEYS of all rows, and more than HOT_ROWS, are hot: there are fewer than HOT_KEYS.
HOT_KEYS, HOT_ROWS = 10_000, 10_000


def few(df: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """`df`, narrow and materialised, marked for a broadcast if it is counted to be small; else it is joined by shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hot_join(rows: DataFrame, keyed: DataFrame, on: list[str], copies: str, how: str = "left") -> DataFrame:
    """Left or inner join of `rows` with `keyed`, unique by `on`, where the column `copies` tells how many rows a key has.

    Hot keys are broadcast, fewer than HOT_KEYS of them, so that no task gets all rows of one; the others are shuffled.
    Both sides are read several times: hand over materialised ones.
    """
    limit = max(HOT_ROWS, (keyed.agg(F.sum(copies)).first()[0] or 0) // HOT_KEYS)
    hot = F.broadcast(keyed.where(F.col(copies) > limit).drop(copies))
    cold = keyed.where(F.col(copies) <= limit).drop(copies)
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(cold, on, how))


def words_lower(column):
    """A-Z lower-cased only, whatever the locale; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_runs(texts: pa.Array, most: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from, to, texts) of runs of about `most` bytes, copied out of a batch one run at a time; a null is empty."""
    raw = texts.cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(raw):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to, [t or b"" for t in raw.slice(at, to - at).to_pylist()]
        at = to


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def kept(kind: str) -> dict:
    """What a worker keeps for later tasks of this kind, whatever task asks."""
    return sys.modules.setdefault("_tallyfold_kept", types.ModuleType("_tallyfold_kept")).__dict__.setdefault(kind, {})


def _let_go(kind: str | None) -> None:
    """Ends what is kept for tasks of other kinds."""
    others = [v for k, v in getattr(sys.modules.get("_tallyfold_kept"), "__dict__", {}).items() if k != kind and isinstance(v, dict) and v and not k.startswith("__")]
    for other in others:
        other.clear()
    if others:
        give_back()


def lean(run: Run, kind: str | None = None) -> Run:
    """`run`, after which a worker gives freed memory back: workers are kept for later tasks, beside other ones.

    Of what is kept() between tasks only that of `kind` outlives the start of this one.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go(kind)
        yield from run(batches)
        del batches
        give_back()

    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


class Shared:
    """A broadcast value whose classes travel by value, too. Its size must be bounded by whoever makes it."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    def __getstate__(self):
        return {"_sent": self._sent, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value


def table(df: DataFrame, kind: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again, for wide results; otherwise like cut()."""
    spark = df.sparkSession
    path, schema = scratch(spark, kind), df.schema
    df.write.parquet(path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


class Tables:
    """Tables in the shared folder that are deleted when what needs them is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, kind: str) -> DataFrame:
        out = table(df, kind)
        self.paths.append(out.inputFiles()[0].rpartition("/")[0] if out.inputFiles() else None)
        return out

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        for p in filter(None, self.paths):
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []

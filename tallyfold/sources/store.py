"""Tables that a plan reads several times, written once to the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Only for sessions on one machine that set no folder, as in tests.
LOCAL_DIR = "/tmp/checkpoints/tallyfold"


def plain_unions(spark: SparkSession) -> None:
    """Unions of parts that are shuffled alike count as not shuffled.

    Spark 4.1 takes such a union for shuffled by the same key, but rows of one key may be in a partition for each part,
    so that groups over it come apart: an invoice then has a row for each rule.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; on a single machine one of our own where it is unset, else that raises."""
    plain_unions(spark)  # whatever is stored here may be grouped over unions
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = LOCAL_DIR
        sc.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh path below the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def stored(df: DataFrame, kind: str) -> DataFrame:
    """`df` written as Parquet and read again: what follows reads it, and nothing before it is computed twice."""
    spark = df.sparkSession
    path, schema = scratch(spark, kind), df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


#: Narrow rows that may be broadcast.
FEW_ROWS = 2_000_000


def few(df: DataFrame) -> DataFrame:
    """`df`, narrow and cheap to count, marked for a broadcast if it has at most FEW_ROWS; else it is joined by shuffles."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


#: Shares of the driver's heap that stay free after a collection, in percent: least and most.
FREE_HEAP = 20, 40


def release(spark: SparkSession) -> None:
    """Lets Spark find what is no longer referred to, so that shuffle files of finished steps don't pile up on the disks.

    The driver's JVM then gives memory back: it plans and compiles every step, and what that took would stay beside the next.
    """
    gc.collect()
    if not getattr(spark.sparkContext, "_tallyfold_lean", False):
        spark.sparkContext._tallyfold_lean = True
        for option, share in zip(("MinHeapFreeRatio", "MaxHeapFreeRatio"), FREE_HEAP, strict=True):
            _asked(spark, "HotSpotDiagnostic", "setVMOption", option, str(share))
    spark.sparkContext._jvm.System.gc()
    _asked(spark, "DiagnosticCommand", "systemTrimNativeHeap")


def _asked(spark: SparkSession, bean: str, operation: str, *texts: str) -> bool:
    """Asks the driver's JVM for an operation of a management bean; whether it did: only some JVMs have them."""
    sc = spark.sparkContext
    jvm, new = sc._jvm, sc._gateway.new_array
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        types, given = new(jvm.java.lang.Class, 4), new(jvm.java.lang.Object, 4)
        for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            types[k] = jvm.java.lang.Class.forName(name)
        given[0], given[1] = jvm.javax.management.ObjectName(f"com.sun.management:type={bean}"), operation
        if texts:
            given[2], given[3] = new(jvm.java.lang.Object, len(texts)), new(jvm.java.lang.String, len(texts))
            for k, text in enumerate(texts):
                given[2][k], given[3][k] = text, "java.lang.String"
        # by the interface, as the server's own class is not open to callers
        jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", types).invoke(server, given)
    except Py4JError:
        return False
    return True


def dropped(df: DataFrame) -> None:
    """Deletes a stored() table that nothing reads any more."""
    files, spark = df.inputFiles(), df.sparkSession
    if files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def state_of(spark: SparkSession, paths: list[str]) -> tuple:
    """Lengths and times of the files, which tell whether a table has changed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)] if fs.exists(path) else [(p, -1, -1)]
    return tuple(out)

"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing a Parquet table and reading it again, so a lost
executor costs a re-read and nothing else.  The folder is the one named by
``spark.checkpoint.dir``.  Where the session names none, a temporary folder is made if
Spark runs in this one process (tests, a laptop); on a cluster it is an error.
"""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
#: paths written so far; inside ``alone``, those written on the way to its result
_WRITTEN: ContextVar[list[str]] = ContextVar("written", default=[])


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="folioscope-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return "file://" + _OWN[0]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioscope/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like ``stage``, as a table bucketed by ``column``: grouping it by that column, or
    cogrouping it with something small, moves none of its rows again."""
    spark = df.sparkSession
    label = f"folioscope_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/folioscope/{label}"
    df.write.bucketBy(buckets, column).option("compression", "zstd").option("path", path).saveAsTable(label)
    _WRITTEN.get().append(path)
    return spark.table(label)


def settle(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans nothing refers to any more; without
    this they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the bytes of an Arrow batch on its way to Python, unless the session does:
    ten thousand long texts would else be one batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)


def alone(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``stage`` what ``make`` returns, and delete the tables written on the way to it."""
    before = _WRITTEN.set([])
    try:
        df = make()
    finally:
        mine = _WRITTEN.get()
        _WRITTEN.reset(before)
    out = stage(df, name)
    _delete(out.sparkSession, mine)
    return out


def clear(spark: SparkSession) -> int:
    """Delete every table written so far; results that read them end with it."""
    return _delete(spark, _WRITTEN.get())


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while paths:
        path = paths.pop()
        label = path.rpartition("/")[2]
        if label.startswith("folioscope_"):
            spark.sql(f"DROP TABLE IF EXISTS {label}")
        path = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow`` or ``mapInPandas``, with memory given back at the end
    of each task.  Python workers live on for later tasks, and what their allocators
    keep adds up in executors that run several operators."""

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        _tidy_malloc()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


@functools.cache
def _tidy_malloc() -> None:
    """Once a process: freed arrays of 8 MB and more go straight back to the system
    (glibc would raise that bound with use)."""
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc only
    if set_option:
        set_option(-3, 8 << 20)  # M_MMAP_THRESHOLD


def give_back() -> None:
    """Return free memory of this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

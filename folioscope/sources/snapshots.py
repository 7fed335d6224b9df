"""Versioned tables on plain Parquet, and exports.

A table is a folder of versions and numbered pointer files, of which the highest names
the current version.  A new version is written in full beside the old one, and then its
pointer appears by one rename to a number that isn't taken: readers see the old table or
the new one, at no moment none, and of two writers that began from the same version the
second one fails."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


_OWN: list[str] = []


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _pointers(spark: SparkSession, table: str) -> list[str]:
    """Names of the pointer files, in rising order."""
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return []
    names = (f.getPath().getName() for f in fs.listStatus(p))
    return sorted(n for n in names if n.startswith("current-"))


def current(spark: SparkSession, table: str) -> str | None:
    found = _pointers(spark, table)
    return spark.read.text(f"{table}/{found[-1]}").first()[0] if found else None


def publish(df: DataFrame, table: str, partition_by: list[str] | None = None, after: str | None = None) -> int:
    """Write the next version and its pointer; returns the number of rows written.
    ``after``: the version the new one was made from; RuntimeError if another has been
    published since."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    known = _pointers(spark, table)
    if after is not None and current(spark, table) != after:
        raise RuntimeError(f"{table} has changed since {after}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table}/{version}")
    number = int(known[-1].rpartition("-")[2]) + 1 if known else 1
    fs, target = _fs(spark, f"{table}/current-{number:012d}")
    _, fresh = _fs(spark, f"{table}/next-{version}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(fresh, target):
        raise RuntimeError(f"{table} was published by another writer meanwhile")
    return spark.read.parquet(f"{table}/{version}").count()


def read(spark: SparkSession, table: str) -> DataFrame:
    version = current(spark, table)
    if version is None:
        raise FileNotFoundError(table)
    return spark.read.parquet(f"{table}/{version}")


def dry_run(df: DataFrame, limit: int = 50) -> tuple[int, list]:
    """What a write would accept, and a sample of it; nothing is written."""
    return df.count(), df.limit(limit).collect()


def vosviewer_map(pairs: DataFrame) -> DataFrame:
    """(id, label, key): ids by first appearance in the ordered pairs
    (position, a_key, a_title, b_key, b_title, count)."""
    ends = pairs.select("position", F.posexplode(F.array(F.struct(F.col("a_key").alias("key"), F.col("a_title").alias("title")), F.struct(F.col("b_key").alias("key"), F.col("b_title").alias("title")))).alias("side", "e"))
    first = ends.groupBy("e.key").agg(F.min(F.struct("position", "side")).alias("at"), F.first("e.title").alias("title"))
    numbered = first.withColumn("id", F.row_number().over(Window.orderBy("at")))  # as many rows as the export's limit allows
    return numbered.select("id", F.coalesce(F.nullif("title", F.lit("")), F.col("key")).alias("label"), "key")


def vosviewer_network(pairs: DataFrame, names: DataFrame) -> DataFrame:
    a, b = names.select(F.col("key").alias("a_key"), F.col("id").alias("id1")), names.select(F.col("key").alias("b_key"), F.col("id").alias("id2"))
    return pairs.join(a, "a_key").join(b, "b_key").select("id1", "id2", F.col("count").alias("weight"))


def coverage_report(rows: DataFrame, categories: list[str]) -> DataFrame:
    """Count per category, with zeros for those that don't occur."""
    known = rows.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    counts = rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, "category", "left").fillna(0, ["n"])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Without one, a single-process
    session gets a temporary folder; on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="folioscope-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return "file://" + _OWN[0]


def scratch(spark: SparkSession):
    """A stage function: writes a table to the shared folder and reads it again, so a
    lineage ends there."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stage

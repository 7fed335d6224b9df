"""Global order without a task that sees every row.

Rows are range-partitioned by the order and written, which fixes the partition each row
fell into; counts per partition (a table of as many rows as there are partitions) turn
numbers inside a partition into global ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.sources.snapshots import scratch


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``_pid``, its partition in the order."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id())
    return scratch(spark)(dealt, "ordered")


def running(df: DataFrame, order: list[str], weight: str, name: str, by: list[str] | None = None) -> DataFrame:
    """A ``ranged`` table with the sum of ``weight`` over all rows up to and with each
    (restarting at each value of ``by``).  The order must tell rows apart."""
    by = by or []
    totals = df.groupBy(*by, "_pid").agg(F.sum(weight).alias("_t"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*(F.col(c).alias(f"_b_{c}") for c in by), F.col("_pid").alias("_op"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*by, "_pid").orderBy(*order)
    same = F.col("_pid") == F.col("_op")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    local = df.withColumn(name, F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return local.join(offsets, same).withColumn(name, F.col(name) + F.col("_o")).drop("_op", "_o", *(f"_b_{c}" for c in by))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the global number (from 1) of each row in the order."""
    table = ranged(df.withColumn("_one", F.lit(1).cast("long")), order)
    return running(table, order, "_one", name).drop("_pid", "_one")

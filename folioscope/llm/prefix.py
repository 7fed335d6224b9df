"""Global prefix sums without a single-task window.

Rows are range-partitioned by the order key and written once, so that the number
of the partition each row fell into is fixed.  Per-partition totals are then a
table with one row per partition (and group); their running sums are offsets that
turn partition-local running sums into global ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.scratch import shuffle_partitions, stage


def ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with ``_pid`` (partition,
    in order) and ``_tie`` (a number that tells equal rows apart)."""
    n = shuffle_partitions(df.sparkSession)
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return stage(tied.repartitionByRange(n, *order, F.col("_tie")).withColumn("_pid", F.spark_partition_id()), name)


def running(df: DataFrame, order: list[Column], sums: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Exclusive running sums over a ``ranged`` table: ``sums`` maps a new column to
    the column it adds up (None: counts rows), restarting at each value of ``by``."""
    by = by or []
    value = {new: F.lit(1).cast("long") if old is None else F.col(old) for new, old in sums.items()}
    per = df.groupBy(*by, "_pid").agg(*(F.sum(v).alias(f"_t_{new}") for new, v in value.items()))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*by, "_pid", *(F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in sums))
    if not by:
        offsets = F.broadcast(offsets)  # one row per partition of the table
    inside = Window.partitionBy(*by, "_pid").orderBy(*order, F.col("_tie")).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({new: F.coalesce(F.sum(v).over(inside), F.lit(0)) for new, v in value.items()})
    same = [local["_pid"] == offsets["_pid"], *(local[c].eqNullSafe(offsets[c]) for c in by)]
    joined = local.join(offsets, same, "left")
    return joined.select(*(local[c] for c in df.columns), *((local[new] + offsets[f"_o_{new}"]).alias(new) for new in sums))

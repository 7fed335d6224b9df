"""Contiguous shards of near-equal bytes, cut from global prefix sums.

Native DataFrame operations only.  Documents are put in the order of (hash of the
text, hash of doc_id), so that equal texts stand together; sizes are summed per
range partition, running sums of those totals give every document its global byte
offset, and the sequence is cut at equal targets.  A cut moves to the nearest
document edge, or, where it falls inside a group of equal texts that is at most
``group_share`` of a shard, to the nearest edge of that group, so small groups of
copies are never divided.  A larger group is divided between documents, since no
balanced shard could hold it.

Defined results: a null text has size 0 plus the overhead, and null texts form one
group; an empty table gives no rows; repeated rows each get a slot of their own;
a document larger than a shard's target leaves neighbours empty rather than being
split; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.prefix import ranged, running


def shard_by_bytes(docs: DataFrame, shards: int, overhead: int = 8, group_share: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard (from 0) and slot (from 0 in each shard)."""
    text = F.col(text_col)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.xxhash64(text, F.lit("text")).alias("_g"),
    ).withColumn("_r", F.xxhash64("doc_id"))
    order = [F.col("_g"), F.col("_r")]
    placed = running(ranged(keyed, order, "shard-keys"), order, {"_at": "size", "_row": None})
    cuts = _cuts(placed, shards, group_share)
    if not cuts:
        return placed.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.col("_row").alias("slot"))
    # a cut never moves by more than a unit: guess from the offset, then step to the right side of it
    edges = F.array(*(F.lit(int(c)) for c in cuts))
    out = placed.withColumn("shard", F.size(F.filter(edges, lambda c: c <= F.col("_at"))).cast("int"))
    first = out.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row per shard
    return out.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def _cuts(placed: DataFrame, shards: int, group_share: float) -> list[int]:
    """Byte offsets at which shards 1, 2, ... begin: as many rows to the driver as
    there are shards."""
    total = placed.agg(F.sum("size")).first()[0] or 0
    if shards < 2 or not total:
        return []
    target = total / shards
    end = F.col("_at") + F.col("size")
    # cuts inside (_at, end]: their numbers, for the few documents that hold any
    low, high = F.floor(F.col("_at") / F.lit(target)) + 1, F.least(F.floor(end / F.lit(target)), F.lit(shards - 1))
    held = placed.withColumn("_k", F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>")))
    crossing = held.select("_g", "_at", "size", F.explode("_k").alias("_k"))
    groups = placed.join(F.broadcast(crossing.select("_g").distinct()), "_g", "left_semi").groupBy("_g").agg(F.min("_at").alias("_from"), F.max(end).alias("_to"))
    cuts = {}
    for row in crossing.join(groups, "_g").collect():  # at most shards - 1 rows
        whole = row["_to"] - row["_from"] <= group_share * target
        left, right = (row["_from"], row["_to"]) if whole else (row["_at"], row["_at"] + row["size"])
        at = row["_k"] * target
        cuts[row["_k"]] = left if at - left <= right - at else right
    return [cuts.get(k, int(k * target)) for k in range(1, shards)]

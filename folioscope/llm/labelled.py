"""The bounded, repeatable sample of labelled documents that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id):
    """crc32 of doc_id as text, modulo 5; fold 0 is held out.  A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, target: str, most: int, text_col: str = "text") -> DataFrame:
    """(text, label) of at most ``most`` labelled documents outside fold 0: those with
    the smallest hashes of their ids, so the sample doesn't depend on order or source.
    Rows of one id with contradicting or null labels are left out."""
    known = labels.groupBy("doc_id").agg(F.min(target).alias("lo"), F.max(target).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(target).alias("m"))
    known = known.filter("lo = hi AND n = m AND lo IN (0, 1)").select("doc_id", F.col("lo").cast("int").alias("label"))
    known = known.filter(fold(F.col("doc_id")) != 0).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "doc_id").select("text", "label", F.xxhash64("doc_id", F.lit("sample")).alias("order"))  # at most ``most`` ids

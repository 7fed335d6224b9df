"""From raw documents to token ids: toxic documents go, one document of each group of
near copies stays, repeated passages are cut out, sources are mixed to their weights,
and the mix is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next stage's ``docs``.

Rows may repeat, share a doc_id or have none, and any column may be null; columns beyond
those of ``documents`` are carried by all stages but the last, whatever their names.  An
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, minhash, mixing, substring, toxicity
from folioscope.llm.queries import table, tokenizer_path
from folioscope.llm.scratch import alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, as they are.  Null and empty texts
    have the lowest score and stay."""
    return toxicity.filter_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near copies.  Rows that
    share this doc_id stay together; documents without words have no copies."""
    keep = minhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_kept_id"]), "left_semi")


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages.  A text that loses nothing
    stays as it is, white space included, and so do nulls; n_chars follows the text."""
    own = [f"_p{i}" for i in range(len(docs.columns))]  # so that no column of ``docs`` clashes
    text, chars = (own[docs.columns.index(c)] for c in ("text", "n_chars"))
    cleaned = substring.remove_repeated(docs.toDF(*own), text_col=text)
    lost = F.col("n_removed") > 0
    kept = {text: F.when(lost, F.col("kept_text")).otherwise(F.col(text)), chars: F.when(lost, F.length("kept_text").cast("long")).otherwise(F.col(chars))}
    return cleaned.withColumns(kept).select(*own).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; texts without words are taken 0 words and
    stay as often as their source's certain copies say."""
    return mixing.mixed_documents(docs)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, their number, and the digest of what they decode
    to, beside doc_id, lang, source and n_chars; no other column is carried.  A null text
    has no ids."""
    path = tokenizer_path()
    coded = bpe.decode(bpe.encode(docs, path, keep=["doc_id", "lang", "source", "n_chars"]), path)
    tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", "lang", "source", "n_chars", tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("minhash", drop_near_copies), ("substring", cut_repeated), ("mixing", mix_sources), ("bpe", to_ids)]

ORACLE_SQL = None  # learned scores, sampled sketches and token ids aren't SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = alone(f"pipeline-{name}", lambda step=step, docs=docs: step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

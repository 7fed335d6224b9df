"""The test tables in the roles of a knowledge base: one SELECT each, the same text for
Spark and for the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WORKS = """SELECT vec_id AS id, concat('W', vec_id) AS key, concat('Title ', vec_id) AS title,
  CASE WHEN vec_id % 7 = 0 THEN NULL ELSE CAST(1990 + vec_id % 30 AS INT) END AS year,
  CASE WHEN label = 0 THEN 'our-document' ELSE 'external-skeleton' END AS kind,
  CASE WHEN label = 0 OR vec_id % 4 = 0 THEN vec_id END AS document_id, embedding FROM embeddings"""
CITES = """SELECT DISTINCT citing, cited, source FROM (
  SELECT l_orderkey % (SELECT max(vec_id) + 1 FROM embeddings) AS citing, l_partkey % (SELECT max(vec_id) + 1 FROM embeddings) AS cited, l_linestatus AS source
  FROM lineitem) e WHERE citing <> cited"""
BASKETS = "SELECT l_orderkey AS citing, l_partkey AS cited, l_linestatus AS source FROM lineitem"
PARTS = "SELECT p_partkey AS id, concat('P', p_partkey) AS key, p_name AS title FROM part"
DOCUMENTS = """SELECT d.doc_id AS id, CASE WHEN d.doc_id % 3 = 0 THEN 'theory/external' ELSE 'theory/iis' END AS source_dir,
  CASE d.doc_id % 10 WHEN 0 THEN 'metadata' WHEN 1 THEN 'transcribed' ELSE 'clean' END AS extraction_state, d.source AS source_tier, d.n_chars AS chars_extracted,
  concat('class-', l.quality) AS legal_class0, CASE WHEN l.doc_id IS NULL THEN NULL ELSE concat('class-', l.quality) END AS legal_class,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'excluded' WHEN l.quality = 0 THEN 'metadata-only' WHEN d.doc_id % 5 = 0 THEN 'internal' ELSE 'full-text' END AS public_distribution,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN d.doc_id % 2 = 0 THEN 'free' ELSE 'by permission' END AS legal_note
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
JOURNAL = """SELECT event_id AS id, CAST(event_id % 3 AS INT) AS depth, CASE event_id % 5 WHEN 0 THEN 'drop' WHEN 1 THEN 'fetch' WHEN 2 THEN 'seed-missing' ELSE 'keep' END AS action,
  CAST(event_id % 997 AS VARCHAR(20)) AS frontier_key, concat('W', event_id % 503) AS candidate_key, CASE WHEN event_id % 5 > 2 THEN concat('W', user_id) END AS node_key,
  CASE WHEN event_id % 2 = 0 THEN 'cites' ELSE 'referenced' END AS relation, value AS score,
  CASE event_id % 4 WHEN 0 THEN concat('node=W', user_id, ' score=0.', event_id % 1000, ' tau=0.5 relation=cites')
    WHEN 1 THEN concat('seed=W', user_id) WHEN 2 THEN concat('hub cited_by_count=', event_id) ELSE 'no text to embed' END AS reason FROM events"""

SOURCES = {"works": (WORKS, ("embeddings",)), "cites": (CITES, ("lineitem", "embeddings")), "baskets": (BASKETS, ("lineitem",)), "parts": (PARTS, ("part",)), "corpus": (DOCUMENTS, ("documents", "labels")), "journal": (JOURNAL, ("events",))}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, tables = SOURCES[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t, df in frames.items():
        sql = sql.replace(f"FROM {t}", "FROM {" + t + "}").replace(f"JOIN {t}", "JOIN {" + t + "}")
    return spark.sql(sql, **frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(*names: str) -> str:
    """WITH clause for the oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({SOURCES[n][0]})" for n in names)

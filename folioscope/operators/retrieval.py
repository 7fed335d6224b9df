"""Page retrieval: exact phrase, vectors, and both fused by rank.

pages: id, document_id, page_number, body, embedding (nullable)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.stemmer import russian_tokens
from folioscope.functions.text import phrase_count, simple_phrase_count, simple_tokens, snippet
from folioscope.functions.vectors import cosine_distance, literal
from folioscope.operators.ordered import numbered
from folioscope.operators.publish import full_content

RRF_K, RANKED = 60, 100
Analyzer = Callable[[Column], Column]


def query_tokens(spark, analyzer: Analyzer, query: str) -> list[str]:
    return spark.range(1).select(analyzer(F.lit(query)).alias("t")).first()["t"]


def phrase_matches(pages: DataFrame, query: str, analyzer: Analyzer = russian_tokens) -> DataFrame:
    """Pages that hold the phrase, with the number of times they do."""
    phrase = query_tokens(pages.sparkSession, analyzer, query)
    if not any(phrase):
        return pages.limit(0).withColumn("hits", F.lit(0))
    if analyzer is simple_tokens:
        return pages.withColumn("hits", simple_phrase_count(F.col("body"), phrase)).filter("hits > 0")
    return pages.withColumn("_t", analyzer(F.col("body"))).withColumn("hits", phrase_count(F.col("_t"), phrase)).filter("hits > 0").drop("_t")


def fulltext(pages: DataFrame, query: str, limit: int = 20, analyzer: Analyzer = russian_tokens) -> DataFrame:
    """In page order, not by relevance."""
    found = phrase_matches(pages, query, analyzer)
    return found.select("document_id", "page_number", snippet(F.col("body")).alias("snippet")).orderBy("document_id", "page_number").limit(limit)


def hit_count(pages: DataFrame, query: str, documents: DataFrame | None = None, analyzer: Analyzer = russian_tokens) -> DataFrame:
    """One row (pages, hits): how many pages match, and how often.  With ``documents`` (id,
    public_distribution) only pages whose body leaves in the public cut are asked."""
    if documents is not None:
        with_body = documents.filter(full_content(F.col("public_distribution"))).select(F.col("id").alias("document_id"))
        pages = pages.join(with_body, "document_id", "left_semi")
    found = phrase_matches(pages, query, analyzer)
    return found.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits"))


def by_distance(pages: DataFrame, target: Sequence[float], digits: int = 5) -> DataFrame:
    """Pages that have a vector, with their rounded cosine distance; bodies left out."""
    return pages.filter(F.col("embedding").isNotNull()).select("id", "document_id", "page_number", F.round(cosine_distance(F.col("embedding"), literal(target)), digits).alias("distance"))


def vector(pages: DataFrame, target: Sequence[float], limit: int = 20) -> DataFrame:
    near = by_distance(pages, target).orderBy("distance", "document_id", "page_number").limit(limit)
    bodies = pages.select("id", snippet(F.col("body")).alias("snippet"))
    return bodies.join(F.broadcast(near), "id").select("document_id", "page_number", "distance", "snippet").orderBy("distance", "document_id", "page_number")


def exact_ranks(pages: DataFrame, target: Sequence[float]) -> DataFrame:
    """Every page's rank by (distance, document, page), as a drift probe wants it."""
    return numbered(by_distance(pages, target), ["distance", "document_id", "page_number"], "rank")


def rank_of(pages: DataFrame, target: Sequence[float], document_id, page_number: int) -> DataFrame:
    """Rank of one page without ranking all: one more than the pages before it."""
    all_ = by_distance(pages, target)
    mine = all_.filter((F.col("document_id") == document_id) & (F.col("page_number") == page_number)).select(*(F.col(c).alias(f"m_{c}") for c in ("distance", "document_id", "page_number"))).limit(1)
    before = F.struct("distance", "document_id", "page_number") < F.struct("m_distance", "m_document_id", "m_page_number")
    return all_.join(F.broadcast(mine)).groupBy("m_document_id", "m_page_number", "m_distance").agg((F.count_if(before) + 1).alias("rank")).select(F.col("m_document_id").alias("document_id"), F.col("m_page_number").alias("page_number"), F.col("m_distance").alias("distance"), "rank")


def runner_up(pages: DataFrame, target: Sequence[float]) -> DataFrame:
    """First and second page, and the margin between them."""
    two = by_distance(pages, target).orderBy("distance", "document_id", "page_number").limit(2)
    ranked = two.withColumn("rank", F.row_number().over(Window.orderBy("distance", "document_id", "page_number")))
    return ranked.select("rank", "document_id", "page_number", "distance")


def rrf(pages: DataFrame, query: str, target: Sequence[float], limit: int = 20, analyzer: Analyzer = russian_tokens) -> DataFrame:
    """Reciprocal rank fusion of the first hundred of each list."""
    words = phrase_matches(pages, query, analyzer).select("id", "document_id", "page_number", "hits").orderBy(F.col("hits").desc(), "id").limit(RANKED)
    words = words.select("id", F.row_number().over(Window.orderBy(F.col("hits").desc(), "id")).alias("r_text"))
    near = by_distance(pages, target).orderBy("distance", "id").limit(RANKED)
    near = near.select("id", F.row_number().over(Window.orderBy("distance", "id")).alias("r_vector"))
    score = F.coalesce(1.0 / (RRF_K + F.col("r_text")), F.lit(0.0)) + F.coalesce(1.0 / (RRF_K + F.col("r_vector")), F.lit(0.0))
    best = words.join(near, "id", "full_outer").withColumn("score", F.round(score, 9)).orderBy(F.col("score").desc(), "id").limit(limit)
    out = pages.select("id", "document_id", "page_number", snippet(F.col("body")).alias("snippet")).join(F.broadcast(best.select("id", "score")), "id")
    return out.select("document_id", "page_number", "score", "snippet").orderBy(F.col("score").desc(), "document_id", "page_number")


def search(pages: DataFrame, query: str, mode: str = "fulltext", limit: int = 20, embed: Callable[[str], Sequence[float] | None] | None = None, analyzer: Analyzer = russian_tokens) -> tuple[DataFrame, str | None]:
    """Result and notice.  Without an embedder vector and hybrid search fall back to
    full text and say so."""
    if mode not in ("fulltext", "vector", "hybrid"):
        raise ValueError(f"unknown mode {mode!r}")
    target = embed(query) if embed and mode != "fulltext" else None
    if mode == "fulltext" or target is None:
        notice = None if mode == "fulltext" else f"{mode} search needs an embedder; showing full-text results"
        return fulltext(pages, query, limit, analyzer), notice
    return (vector(pages, target, limit) if mode == "vector" else rrf(pages, query, target, limit, analyzer)), None


def lexeme_overlap(pages: DataFrame, queries: DataFrame, pairs: DataFrame, analyzer: Analyzer = simple_tokens) -> DataFrame:
    """(query_id, id, lexemes): what each given pair (query_id, id) shares, in order."""
    left = queries.select("query_id", F.array_distinct(analyzer(F.col("text"))).alias("_q"))
    right = pages.select("id", F.array_distinct(analyzer(F.col("body"))).alias("_p"))
    both = pairs.join(left, "query_id").join(right, "id")
    return both.select("query_id", "id", F.array_sort(F.array_intersect("_q", "_p")).alias("lexemes"))

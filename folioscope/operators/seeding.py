"""What a crawl starts from: our documents, what is stored about them, and the order in
which stored, cached and fetched answers count.

works: document_id, abstract, evidence (map), titles, years, key, embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_seeds(documents: DataFrame, source_dir: str = "theory/iis") -> DataFrame:
    """Documents of our tree that have a text."""
    return documents.filter((F.col("source_dir") == source_dir) & (F.col("extraction_state") != "metadata")).select("id")


def seed_matches(seeds: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, record) of seeds that have a match (document_id, record), and the ids without."""
    known = matches.filter("record IS NOT NULL AND record <> ''").groupBy(F.col("document_id").alias("id")).agg(F.min("record").alias("record"))
    return seeds.join(known, "id"), seeds.join(known, "id", "left_anti")


def stored_abstracts(works: DataFrame, source: str = "zbmath") -> DataFrame:
    """(document_id, value): abstracts a work has from one source."""
    mine = works.filter(F.col("document_id").isNotNull() & (F.col("evidence")["abstract_source"] == source) & (F.col("abstract") != ""))
    return mine.select("document_id", F.col("abstract").alias("value"))


def stored_titles(works: DataFrame) -> DataFrame:
    """(document_id, titles, years) where there is at least one title."""
    mine = works.filter(F.col("document_id").isNotNull() & (F.size(F.coalesce("titles", F.array())) > 0))
    return mine.select("document_id", "titles", F.coalesce("years", F.array().cast("array<int>")).alias("years"))


def known_vectors(works: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, embedding) of the keys that have one."""
    return works.filter("embedding IS NOT NULL").join(keys.select("key").distinct(), "key", "left_semi").select("key", "embedding")


def with_precedence(asked: DataFrame, stored: DataFrame, cached: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """asked (document_id); the others (document_id, value), fetched with ``error`` too.

    (document_id, value, origin): stored before cached before fetched.  Second, failures
    (document_id, error) of what only a fetch could have answered; an answer that says
    there is nothing is no failure."""
    sides = [df.groupBy("document_id").agg(F.min("value").alias(name)) for name, df in (("stored", stored), ("cached", cached))]
    got = fetched.groupBy("document_id").agg(F.min("value").alias("fetched"), F.min("error").alias("error"))
    rows = asked.select("document_id").distinct()
    for side in [*sides, got]:
        rows = rows.join(side, "document_id", "left")
    value = F.coalesce("stored", "cached", "fetched")
    origin = F.when(F.col("stored").isNotNull(), "stored").when(F.col("cached").isNotNull(), "cached").otherwise("fetched")
    answers = rows.filter(value.isNotNull()).select("document_id", value.alias("value"), origin.alias("origin"))
    return answers, rows.filter(value.isNull() & F.col("error").isNotNull()).select("document_id", "error")


def vectors_of(texts: DataFrame, stored: DataFrame, embed: Callable[[list[str]], list[list[float]]], dims: int, batch: int = 16) -> DataFrame:
    """texts (id, text), stored (id, embedding): each id's vector, the stored one where there
    is one, else a new one; only the others reach the embedder, ``batch`` texts a call."""
    from folioscope.streaming.journal import embed_pending

    known = stored.filter("embedding IS NOT NULL").select("id", F.col("embedding").cast("array<float>").alias("embedding"))
    have = known.join(texts.select("id"), "id", "left_semi")
    return have.unionByName(embed_pending(texts.join(known.select("id"), "id", "left_anti"), embed, dims, batch))

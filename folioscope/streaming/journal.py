"""Extension: the journal and pending embeddings as streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.operators.merge import insert_edges
from folioscope.sources import snapshots


def action_counts(journal: DataFrame, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Decisions per action and time window; late rows up to ``delay`` still count."""
    return journal.withWatermark("at", delay).groupBy(F.window("at", window), "action").agg(F.count(F.lit(1)).alias("n"))


def merge_edges(stream: DataFrame, works_table: str, cites_table: str, checkpoint: str) -> StreamingQuery:
    """Each batch of (citing_key, cited_key, source) is merged into the edge table; a
    batch that is delivered twice adds nothing."""
    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        cites = snapshots.read(spark, cites_table)
        fresh = insert_edges(cites, snapshots.read(spark, works_table), batch)
        snapshots.publish(cites.unionByName(fresh), cites_table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def embed_pending(rows: DataFrame, embed: Callable[[list[str]], list[list[float]]], dims: int, batch: int = 16) -> DataFrame:
    """(id, text) -> (id, embedding), ``batch`` texts a call; a wrong number of vectors
    or dimensions is an error.  Works on streams and tables alike."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[pdf["text"].str.strip() != ""]
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                vectors = embed(part["text"].tolist())
                if len(vectors) != len(part) or any(len(v) != dims for v in vectors):
                    raise ValueError("the embedder's answer doesn't fit the request")
                yield pd.DataFrame({"id": part["id"], "embedding": list(vectors)})

    return rows.select("id", "text").mapInPandas(run, "id long, embedding array<float>")

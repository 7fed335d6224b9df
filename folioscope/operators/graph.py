"""Citation-graph analytics over two tables: works (id, key, title, year, kind,
document_id, embedding) and cites (citing, cited, source)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.vectors import cosine, l2_normalize, literal

OURS, SKELETON = "our-document", "external-skeleton"
DEPTHS = (1, 2, 3)


def both_directions(cites: DataFrame) -> DataFrame:
    """(node, other) for every edge, seen from either end."""
    return cites.select(F.col("citing").alias("node"), F.col("cited").alias("other")).unionByName(cites.select(F.col("cited").alias("node"), F.col("citing").alias("other")))


def centroid_avg(vectors: DataFrame, column: str = "embedding") -> list[float]:
    """Mean by position, not normalised, over the vectors that have the position: sums by
    position are made in every partition, and one row of as many numbers comes back."""
    known = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0))
    width = known.agg(F.max(F.size(column))).first()[0]
    if not width:
        return []
    mean = [F.avg(F.get(F.col(column), i).cast("double")) for i in range(width)]
    return [x for i in range(0, width, 64) for x in known.agg(*mean[i : i + 64]).first()]


def centroid_unit(vectors: DataFrame, column: str = "embedding") -> list[float]:
    """Normalise each, average, normalise.  No vectors or ragged ones are an error."""
    known = vectors.filter(F.col(column).isNotNull())
    widths = [r[0] for r in known.select(F.size(column)).distinct().limit(2).collect()]
    if len(widths) != 1:
        raise ValueError("no vectors" if not widths else "vectors of different widths")
    mean = centroid_avg(known.select(l2_normalize(F.col(column)).alias(column)), column)
    n = sum(x * x for x in mean) ** 0.5
    return [x / n for x in mean] if n else mean


def nearest(works: DataFrame, target: Sequence[float], top: int, digits: int = 5) -> DataFrame:
    """The ``top`` works by cosine (rounded, then by id) with their score."""
    score = F.round(cosine(F.col("embedding"), literal(target)), digits)
    scored = works.filter(F.col("embedding").isNotNull()).withColumn("score", score).drop("embedding")
    return scored.orderBy(F.col("score").desc(), "id").limit(top)


def candidates(works: DataFrame, cites: DataFrame, top: int = 20, target: Sequence[float] | None = None, min_links: int = 0) -> DataFrame:
    """Skeletons nearest to the target (the centroid of our documents by default) with
    the number of different documents of ours they are linked to.  The cut by
    ``min_links`` comes after the cut to ``top``."""
    if target is None:
        target = centroid_avg(works.filter(F.col("kind") == OURS))
        if not target:
            return works.select("key", "year", "title", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("links")).limit(0)
    near = F.broadcast(nearest(works.filter(F.col("kind") == SKELETON), target, top))  # at most ``top`` rows
    ours = works.filter(F.col("kind") == OURS).select(F.col("id").alias("other"))
    touched = both_directions(cites).join(near.select(F.col("id").alias("node")), "node", "left_semi").distinct()
    links = touched.join(ours, "other", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    out = near.join(F.broadcast(links), near["id"] == links["node"], "left")
    out = out.select("key", "year", "title", "score", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return out.filter(F.col("links") >= min_links).orderBy(F.col("score").desc(), F.col("links").desc(), "key")


def citers(works: DataFrame, cites: DataFrame, document_id, depth: int = 1) -> DataFrame:
    """Works that reach the document along 1..depth citations; one frontier join a
    step.  The document itself is among them where it lies on a short cycle."""
    if depth not in DEPTHS:
        raise ValueError(f"depth {depth} is not one of {DEPTHS}")
    seed = works.filter(F.col("document_id") == document_id).orderBy("key").limit(1).select(F.col("id").alias("node"))
    edges = cites.select("citing", "cited").distinct()
    frontier, found = seed, None
    for _ in range(depth):
        frontier = edges.join(frontier.withColumnRenamed("node", "cited"), "cited", "left_semi").select(F.col("citing").alias("node")).distinct()
        found = frontier if found is None else found.union(frontier)
    hit = works.join(found.distinct().withColumnRenamed("node", "id"), "id", "left_semi")
    return hit.select("key", "title", "year", "kind").orderBy(F.col("year").asc_nulls_last(), "key")


def cocitation(works: DataFrame, cites: DataFrame, min_count: int = 2, max_out_degree: int = 200, limit: int = 500) -> DataFrame:
    """Pairs cited together.  The cap on a citer's rows comes before the pairing: it is
    the meaning of the query and bounds the pairs of one citer."""
    small = cites.groupBy("citing").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= max_out_degree).select("citing")
    thin = cites.join(small, "citing", "left_semi").groupBy("citing").agg(F.sort_array(F.collect_set("cited")).alias("refs"))
    first = thin.select("refs", F.posexplode("refs").alias("i", "a"))
    pairs = first.select("a", F.explode(F.slice("refs", F.col("i") + 2, F.greatest(F.size("refs") - F.col("i") - 1, F.lit(0)))).alias("b"))
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)
    names = works.select("id", "key", F.coalesce("title", F.lit("")).alias("title"))
    one = names.select(F.col("id").alias("a"), F.col("key").alias("a_key"), F.col("title").alias("a_title"))
    two = names.select(F.col("id").alias("b"), F.col("key").alias("b_key"), F.col("title").alias("b_title"))
    out = counted.join(one, "a").join(two, "b").select("a_key", "a_title", "b_key", "b_title", "count")
    return out.orderBy(F.col("count").desc(), "a_key", "b_key").limit(limit)


def hybrid(works: DataFrame, cites: DataFrame, target: Sequence[float], top: int = 10) -> DataFrame:
    """The nearest works of any kind with what they cite and what cites them."""
    seeds = F.broadcast(nearest(works, target, top).select("id", F.col("key").alias("key"), "year", F.coalesce("title", F.lit("")).alias("title"), "score").filter("key != ''"))
    other = works.select(F.col("id").alias("other"), F.col("key").alias("neighbor_key"), F.coalesce("title", F.lit("")).alias("neighbor_title")).filter("neighbor_key != ''")
    out = []
    for name, mine, theirs in (("cites", "citing", "cited"), ("cited_by", "cited", "citing")):
        rows = cites.select(F.col(mine).alias("id"), F.col(theirs).alias("other")).join(seeds, "id").join(other, "other")
        out.append(rows.withColumn("direction", F.lit(name)))
    both = out[0].unionByName(out[1]).select("key", "year", "title", "score", "direction", "neighbor_key", "neighbor_title")
    return both.orderBy(F.col("score").desc(), "key", "direction", "neighbor_key")


def kind_census(works: DataFrame, where: Column | None = None) -> DataFrame:
    kept = works if where is None else works.filter(where)
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def project(works: DataFrame, cites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices with their set properties, and numbered edges; always a full rebuild.
    An edge is the triple (start_id, end_id, source); its id is a 64-bit digest of that, stable
    and without a global sort, but not proof against collisions among billions of edges."""
    vertices = works.select("id", "key", "kind", "year", "title", F.to_json(F.struct("key", "kind", "year", "title")).alias("properties"))
    edges = cites.select(F.xxhash64("citing", "cited", "source").alias("id"), F.col("citing").alias("start_id"), F.col("cited").alias("end_id"), "source")
    return vertices, edges


def _digest(lines: DataFrame, line: Column, order: list[str]) -> DataFrame:
    """md5 of all lines in order, one line break between.  A digest is made front to back,
    so one task reads the sorted lines, but as a stream: it holds a batch at a time."""
    rows = lines.select(*order, line.alias("_line")).orderBy(*order).select("_line").coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, between = hashlib.md5(), b""
        for batch in batches:
            for text in batch.column(0).to_pylist():
                digest.update(between + text.encode())
                between = b"\n"
        yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()])], names=["digest"])

    done = rows.mapInArrow(run, "digest string")
    return done.agg(F.coalesce(F.max("digest"), F.md5(F.lit(""))).alias("digest"))  # no partition, no row


def projection_digest(works: DataFrame, cites: DataFrame) -> DataFrame:
    """Counts and ordered digests of works and edges (what a projection must match)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    vertex = F.concat_ws("|", *map(blank, ("key", "kind", "year", "title")))
    keys = works.select("id", "key")
    named = cites.join(keys.select(F.col("id").alias("citing"), F.col("key").alias("a")), "citing").join(keys.select(F.col("id").alias("cited"), F.col("key").alias("b")), "cited")
    edge = F.concat_ws("|", "a", "b", "source")
    counts = works.agg(F.count(F.lit(1)).alias("works")).crossJoin(named.agg(F.count(F.lit(1)).alias("edges")))
    return counts.crossJoin(_digest(works, vertex, ["key"]).withColumnRenamed("digest", "works_md5")).crossJoin(_digest(named, edge, ["a", "b", "source"]).withColumnRenamed("digest", "edges_md5"))


def projection_faults(reading: DataFrame, projected: DataFrame) -> list[str]:
    """What differs between two readings (one row each); equal counts don't excuse
    different content."""
    a, b = reading.first(), projected.first()
    if b is None:
        return ["the graph is missing"]
    return [f"{c}: {a[c]} is not {b[c]}" for c in a.asDict() if a[c] != b[c]]


def among_known(aliases: DataFrame, frontier: DataFrame, frontier_refs: DataFrame, candidate_refs: DataFrame, provenance: DataFrame) -> DataFrame:
    """Edges between known nodes only: (citing, cited, relation, discovered_from).

    aliases (ref, key); frontier (key); frontier_refs (key, ref); candidate_refs
    (record, ref); provenance (record, position, relation, source_key), of which the
    first position counts."""
    target = aliases.select(F.col("ref"), F.col("key").alias("cited"))
    own = frontier_refs.join(frontier, "key", "left_semi").join(target, "ref").select(F.col("key").alias("citing"), "cited", F.lit("referenced").alias("relation"), F.col("key").alias("discovered_from"))
    first = provenance.groupBy("record").agg(F.min(F.struct("position", "relation", "source_key")).alias("f")).select("record", "f.relation", "f.source_key")
    via = candidate_refs.join(aliases.select(F.col("ref").alias("record"), F.col("key").alias("citing")), "record").join(target, "ref").join(first, "record", "left")
    via = via.select("citing", "cited", F.coalesce("relation", F.lit("")).alias("relation"), F.coalesce(F.nullif("source_key", F.lit("")), F.col("citing")).alias("discovered_from"))
    return own.unionByName(via).filter("citing != cited").distinct()

"""Level-by-level snowball expansion over a table of records, with a measured
relevance threshold, a hub cap, an identity union and a full decision journal.

records: id, doi, title, year, cited_by_count, refs (array), embedding.  Nodes are
named by the id of the record that founded them; ``aliases`` (ref, key) says which ids
and DOIs stand for which node.  The driver only loops over levels; each level is a
handful of joins, and its tables are written to the shared folder before the next."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import normalize_doi
from folioscope.functions.vectors import cosine_unit, literal
from folioscope.operators.stats import keeps

UNTITLED = -1.0
JOURNAL = "depth int, frontier_key string, candidate_key string, action string, node_key string, score double, tau double, relation string, cited_by_count long, n_found long, n_kept long, reason string"


# What the journal calls its steps, and the reasons a reader finds there.
ACTIONS = ("seed", "seed-missing", "keep", "drop", "hub-skip", "fetch", "error")
KEPT, TOO_FAR, NO_TEXT = "kept", "below-threshold", "no text to embed"


def step(rows: DataFrame, action: str, depth: int, **columns: Column) -> DataFrame:
    """Journal rows of one action, with the columns given; an action outside the
    vocabulary is an error."""
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}, known are {', '.join(ACTIONS)}")
    return rows.select(F.lit(depth).alias("depth"), F.lit(action).alias("action"), *(v.alias(n) for n, v in columns.items()))


def drop_reason(score: Column) -> Column:
    """A score of UNTITLED or less says that there was nothing to measure."""
    return F.when(score <= UNTITLED, NO_TEXT).otherwise(TOO_FAR)


def expandable(frontier: DataFrame, depth: int, skip: DataFrame | None = None) -> DataFrame:
    """Depth 0 and 1 expand whole; deeper only what was found by citing."""
    rows = frontier if depth <= 1 else frontier.filter("relation = 'cites'")
    return rows if skip is None else rows.join(skip, "key", "left_anti")


def gather(records: DataFrame, aliases: DataFrame, frontier: DataFrame, hub_cap: int) -> tuple[DataFrame, DataFrame]:
    """Candidates (record, relation, hits, hit) and hubs.  Upwards: records that refer to a
    frontier node that is no hub; downwards: what frontier nodes refer to and isn't
    known.  A record found both ways counts as found by citing."""
    hubs = frontier.filter(F.col("cited_by_count") > hub_cap)
    mine = aliases.join(frontier.select("key"), "key", "left_semi")
    open_ = mine.join(hubs.select("key"), "key", "left_anti")
    unknown = records.join(aliases.select(F.col("ref").alias("id")), "id", "left_anti")
    up = unknown.select("id", F.explode("refs").alias("ref")).join(open_, "ref").groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("hits")).withColumn("relation", F.lit("cites"))
    down = records.join(mine.withColumnRenamed("ref", "id"), "id").select("key", F.explode("refs").alias("id")).join(unknown.select("id"), "id", "left_semi")
    down = down.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("hits")).withColumn("relation", F.lit("referenced"))
    both = up.unionByName(down).groupBy("id").agg(F.min("relation").alias("relation"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"))
    return both.withColumn("hit", F.coalesce(F.array_min("hits"), F.lit(""))), hubs


def score(records: DataFrame, candidates: DataFrame, centroid: Sequence[float]) -> DataFrame:
    rows = records.join(candidates, "id")
    blank = F.trim(F.coalesce("title", F.lit(""))) == ""
    value = F.when(blank | F.col("embedding").isNull(), F.lit(UNTITLED)).otherwise(cosine_unit(F.col("embedding"), literal(centroid)))
    return rows.withColumn("score", value)


def union_identities(kept: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id -> key) for kept records, and the aliases they add.  A record that shares a
    DOI with a known node or with an earlier record of the level is absorbed by it; a
    record that bridges two nodes joins the one with the smaller name, and the nodes
    stay two.  A column ``ids`` (an array, as ``functions.records.record_ids`` makes it)
    holds further identifiers that count like the DOI."""
    claims = F.array_compact(F.array(F.col("id"), F.nullif(F.concat(F.lit("doi:"), normalize_doi(F.col("doi"))), F.lit("doi:"))))
    if "ids" in kept.columns:
        claims = F.array_union(claims, F.array_compact(F.coalesce("ids", F.array().cast("array<string>"))))
    names = kept.select("id", F.explode(F.array_distinct(claims)).alias("ref"))
    known = names.join(aliases, "ref").groupBy("id").agg(F.min("key").alias("old"))
    first = names.groupBy("ref").agg(F.min("id").alias("founder"))
    own = names.join(first, "ref").groupBy("id").agg(F.min("founder").alias("founder"))
    key = own.join(known, "id", "left").select("id", "founder", F.coalesce("old", "founder").alias("key"))
    founder = key.select(F.col("id").alias("founder"), F.col("key").alias("fkey"))
    key = key.join(founder, "founder", "left").select("id", F.when(F.col("key") == F.col("founder"), F.coalesce("fkey", "key")).otherwise(F.col("key")).alias("key"))
    fresh = names.join(key, "id").groupBy("ref").agg(F.min("key").alias("key")).join(aliases.select("ref"), "ref", "left_anti")
    return key, fresh


def absorb(rows: DataFrame) -> DataFrame:
    """Records of one node become its row: first title and year in order of id, counters
    added up, references united."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col("id"))).alias(c)
    return rows.groupBy("key").agg(first("title"), first("year"), F.sum("cited_by_count").alias("cited_by_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("refs")))).alias("refs"), F.min("relation").alias("relation"), F.max("score").alias("score"), F.array_sort(F.collect_set("title")).alias("titles"))


def grown(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Nodes with what was found of them at a later level: their own title, year, relation,
    score and depth where they have one, counters added up, references and titles united."""
    more = found.select("key", *(F.col(c).alias(f"_{c}") for c in ("title", "year", "cited_by_count", "refs", "titles")))
    both = lambda c: F.array_sort(F.array_union(F.coalesce(c, F.array()), F.coalesce(f"_{c}", F.array())))
    out = {
        "title": F.coalesce(F.nullif("title", F.lit("")), "_title"), "year": F.coalesce("year", "_year"), "refs": both("refs"), "titles": both("titles"),
        "cited_by_count": F.coalesce("cited_by_count", F.lit(0)) + F.coalesce("_cited_by_count", F.lit(0)),
    }
    return nodes.join(more, "key", "left").withColumns(out).select(*nodes.columns)


@dataclass
class Snowball:
    """records, the stage function that cuts lineage, threshold and hub cap."""

    records: DataFrame
    stage: Callable[[DataFrame, str], DataFrame]
    tau: float
    hub_cap: int = 5000
    nodes: DataFrame | None = None
    aliases: DataFrame | None = None
    journal: list[DataFrame] = field(default_factory=list)
    centroid: list[float] = field(default_factory=list)

    def seed(self, seeds: DataFrame) -> DataFrame:
        """seeds (document_id, id): seeds without a record are journalled as missing."""
        from folioscope.operators.graph import centroid_unit

        found = seeds.join(self.records, "id")
        missing = seeds.join(self.records.select("id"), "id", "left_anti")
        self._write(step(missing, "seed-missing", 0, frontier_key=F.col("document_id")))
        rows = found.withColumns({"relation": F.lit("seed"), "score": F.lit(1.0)})
        empty = self.records.sparkSession.createDataFrame([], "ref string, key string")
        key, fresh = union_identities(rows, empty)
        self.aliases = self.stage(fresh, "aliases")
        self.nodes = self.stage(absorb(rows.join(key, "id")).withColumn("depth", F.lit(0)), "nodes")
        self._write(step(found.join(key.withColumnRenamed("key", "node_key"), "id"), "seed", 0, frontier_key=F.col("document_id"), node_key=F.col("node_key")))
        self.centroid = centroid_unit(found)
        return self.nodes

    def expand(self, frontier: DataFrame, depth: int) -> DataFrame:
        """One level: gathers, scores, keeps or drops, writes the journal; returns the
        new nodes."""
        candidates, hubs = gather(self.records, self.aliases, frontier, self.hub_cap)
        scored = self.stage(score(self.records, candidates, self.centroid).withColumn("kept", keeps(F.col("score"), self.tau)), "scored")
        kept = scored.filter("kept")
        key, fresh = union_identities(kept, self.aliases)
        key = self.stage(key, "keys")
        found = self.stage(absorb(kept.join(key, "id")), "found")
        level = self.stage(found.join(self.nodes.select("key"), "key", "left_anti").withColumn("depth", F.lit(depth)), "level")
        self._write(step(hubs, "hub-skip", depth, frontier_key=F.col("key"), node_key=F.col("key"), cited_by_count=F.col("cited_by_count")))
        what = {"frontier_key": F.nullif("hit", F.lit("")), "candidate_key": F.col("id"), "score": F.col("score"), "tau": F.lit(self.tau), "relation": F.col("relation")}
        named = kept.join(key.withColumnRenamed("key", "node_key"), "id")
        self._write(step(named, "keep", depth, **what, node_key=F.col("node_key"), reason=F.lit(KEPT)))
        self._write(step(scored.filter(~F.col("kept")), "drop", depth, **what, reason=drop_reason(F.col("score"))))
        counts = scored.select(F.explode("hits").alias("frontier_key"), "kept").groupBy("frontier_key").agg(F.count(F.lit(1)).alias("n_found"), F.count_if("kept").alias("n_kept"))
        credited = frontier.select(F.col("key").alias("frontier_key")).join(counts, "frontier_key", "left").fillna(0, ["n_found", "n_kept"])
        self._write(step(credited, "fetch", depth, **{c: F.col(c) for c in ("frontier_key", "n_found", "n_kept")}))
        self.aliases = self.stage(self.aliases.unionByName(fresh), "aliases")
        self.nodes = self.stage(grown(self.nodes, found).unionByName(level), "nodes")
        return level

    def run(self, depth: int) -> DataFrame:
        frontier = self.nodes
        for level in range(1, depth + 1):
            frontier = self.expand(expandable(frontier, level - 1), level)
            if not frontier.limit(1).count():
                break
        return self.nodes

    def calibrate(self) -> DataFrame:
        """Scores of depth 1 without touching nodes or journal."""
        candidates, _ = gather(self.records, self.aliases, self.nodes, self.hub_cap)
        return score(self.records, candidates, self.centroid).select(F.col("id").alias("candidate_key"), "relation", "score", "title", "year", "refs")

    def edges(self) -> DataFrame:
        """Citations between nodes: never to itself, each once."""
        refs = self.nodes.select(F.col("key").alias("citing"), F.explode("refs").alias("ref")).join(self.aliases, "ref")
        return refs.select("citing", F.col("key").alias("cited")).filter("citing != cited").distinct()

    def steps(self) -> DataFrame:
        """The journal in order of writing."""
        out = None
        for i, part in enumerate(self.journal):
            row = part.withColumn("batch", F.lit(i))
            out = row if out is None else out.unionByName(row)
        return out

    def _write(self, rows: DataFrame) -> None:
        have = dict(rows.dtypes)
        columns = [f.strip().split() for f in JOURNAL.split(",")]
        self.journal.append(self.stage(rows.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns)), "journal"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")

"""Upserts as projections over a full outer join: old and new table in, next version
and number of accepted rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOREIGN_STATES = ("transcribed", "ocr", "metadata")


def _joined(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    a = old.select(F.struct(*old.columns).alias("o"), *(F.col(k).alias(f"_{k}") for k in keys))
    b = new.select(F.struct(*new.columns).alias("n"), *(F.col(k).alias(f"_{k}") for k in keys))
    return a.join(b, [f"_{k}" for k in keys], "full_outer")


def _new_or_old(column: str) -> Column:
    return F.coalesce(F.col(f"n.{column}"), F.col(f"o.{column}"))


def require_unique(rows: DataFrame, keys: list[str]) -> None:
    twice = rows.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"keys given twice in one batch: {[tuple(r[k] for k in keys) for r in twice]}")


def upsert_documents(old: DataFrame, staged: DataFrame, source_dir: str, owned_by_others: tuple[str, ...] = FOREIGN_STATES) -> DataFrame:
    """Staged columns replace old ones, except in rows of another loader's state or
    another tree."""
    rows = _joined(old, staged, ["id"])
    mine = ~F.col("o.extraction_state").isin(*owned_by_others) & (F.col("o.source_dir") == source_dir)
    take = F.col("n").isNotNull() & (F.col("o").isNull() | F.coalesce(mine, F.lit(False)))
    value = lambda c: F.when(take, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in staged.columns else F.col(f"o.{c}")
    return rows.select(*(value(c).alias(c) for c in old.columns))


def refuse_foreign_ids(old: DataFrame, staged: DataFrame, source_dir: str) -> None:
    """ValueError where a staged id is held by a document of another tree: the upsert
    would pass over it without a word."""
    held = old.filter(~F.col("source_dir").eqNullSafe(F.lit(source_dir))).join(staged.select("id").distinct(), "id", "left_semi")
    names = [r[0] for r in held.select("id").orderBy("id").limit(5).collect()]
    if names:
        raise ValueError(f"ids of another tree: {names}")


def upsert_pages(old: DataFrame, staged: DataFrame) -> DataFrame:
    """The vector of a page survives exactly as long as its body does."""
    rows = _joined(old, staged, ["document_id", "page_number"])
    same = F.col("o.body").eqNullSafe(F.col("n.body"))
    embedding = F.when(F.col("n").isNull(), F.col("o.embedding")).when(F.col("o").isNotNull() & same, F.col("o.embedding"))
    body = F.when(F.col("n").isNull(), F.col("o.body")).otherwise(F.col("n.body"))
    return rows.select(_new_or_old("document_id").alias("document_id"), _new_or_old("page_number").alias("page_number"), body.alias("body"), embedding.alias("embedding"))


def delete_vanished(old: DataFrame, staged: DataFrame, scope: Column, key: str = "id") -> DataFrame:
    """Rows in the scope that the new batch no longer has are gone."""
    present = staged.select(F.col(key).alias("_k")).distinct().withColumn("_there", F.lit(True))
    return old.join(present, old[key] == F.col("_k"), "left").filter(F.col("_there").isNotNull() | ~F.coalesce(scope, F.lit(False))).select(*old.columns)


WORK_KEPT = ("doi", "title", "abstract", "year", "authors", "external_ids", "document_id", "embedding")
WORK_REPLACED = ("source", "evidence", "fetched_at")


def upsert_works(old: DataFrame, staged: DataFrame) -> DataFrame:
    """New values win where there are any; source, evidence and time always; a sighting
    as a skeleton doesn't demote our documents or indexed works."""
    require_unique(staged, ["key"])
    rows = _joined(old, staged, ["key"])
    new = F.col("n").isNotNull()
    keep = F.col("o.kind").isin("our-document", "indexed") & (F.col("n.kind") == "external-skeleton")
    out = {c: _new_or_old(c) for c in old.columns if c in WORK_KEPT and c in staged.columns}
    out |= {c: F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) for c in old.columns if c in WORK_REPLACED and c in staged.columns}
    out["key"] = _new_or_old("key")
    out["kind"] = F.when(F.coalesce(keep, F.lit(False)), F.col("o.kind")).when(new, F.col("n.kind")).otherwise(F.col("o.kind"))
    return rows.select(*(out.get(c, F.col(f"o.{c}")).alias(c) for c in old.columns))


def insert_edges(cites: DataFrame, works: DataFrame, staged: DataFrame) -> DataFrame:
    """staged (citing_key, cited_key, source).  Unknown ends and self-citations are
    dropped, edges already there stay as they are: the rows to append."""
    keys = works.select("id", "key")
    named = staged.join(keys.select(F.col("key").alias("citing_key"), F.col("id").alias("citing")), "citing_key").join(keys.select(F.col("key").alias("cited_key"), F.col("id").alias("cited")), "cited_key")
    fresh = named.filter("citing != cited").select("citing", "cited", "source").distinct()
    return fresh.join(cites, ["citing", "cited", "source"], "left_anti")


def promote_twins(works: DataFrame, twins: DataFrame) -> DataFrame:
    """twins (key, document_id, twin_of, twin_rule): those works become ours, and what
    they are twins of is added to their evidence (a map)."""
    t = twins.select(F.col("key").alias("_k"), F.col("document_id").alias("_d"), "twin_of", "twin_rule")
    rows = works.join(t, works["key"] == t["_k"], "left")
    hit = F.col("_k").isNotNull()
    added = F.map_filter(F.coalesce("evidence", F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("twin_of", "twin_rule"))
    merged = F.map_concat(added, F.create_map(F.lit("twin_of"), F.col("twin_of"), F.lit("twin_rule"), F.col("twin_rule")))
    new = {"kind": F.when(hit, "our-document").otherwise(F.col("kind")), "document_id": F.when(hit, F.col("_d")).otherwise(F.col("document_id")), "evidence": F.when(hit, merged).otherwise(F.col("evidence"))}
    return rows.select(*(new.get(c, F.col(c)).alias(c) for c in works.columns))


def replace_by(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Delete and insert: rows of the keys in ``new`` are replaced whole; columns that
    ``new`` hasn't are reset."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True).select(*old.columns)


def fill_column(old: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """The column from ``values`` where it has the key, else as it was."""
    v = values.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    rows = old.join(v, old[key] == F.col("_k"), "left")
    return rows.select(*(F.coalesce("_v", c).alias(c) if c == column else F.col(c) for c in old.columns))


def declare_once(old: DataFrame, new: DataFrame) -> DataFrame:
    """A singleton table: the first declaration stands."""
    return old if old.limit(1).count() else new.limit(1)


def upsert_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert, or replace on equal keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def pending(rows: DataFrame, text: Column) -> DataFrame:
    """Rows without a vector that have text other than spaces."""
    return rows.filter(F.col("embedding").isNull() & (F.trim(text) != ""))


def find_twins(works: DataFrame, seeds: DataFrame, years: DataFrame) -> DataFrame:
    """works (key, title, year, doi); seeds (key, document_id, titles, mathnet_id);
    years (document_id, years).  (key, document_id, twin_of, twin_rule)."""
    from folioscope.functions.text import doi_suffix, normalize_title, year_matches

    ids = seeds.filter("mathnet_id IS NOT NULL AND trim(mathnet_id) != ''").groupBy(F.lower(F.trim("mathnet_id")).alias("suffix")).agg(F.max(F.struct("key", "document_id")).alias("s"))
    titles = seeds.select("key", "document_id", F.explode("titles").alias("t")).withColumn("norm", normalize_title(F.col("t"))).filter("norm != ''")
    titles = titles.groupBy("norm").agg(F.max(F.struct("key", "document_id")).alias("s"), F.count_distinct("document_id").alias("n")).filter("n = 1").select("norm", F.col("s").alias("ts"))
    rows = works.withColumn("suffix", doi_suffix(F.col("doi"))).withColumn("norm", normalize_title(F.col("title")))
    rows = rows.join(ids, "suffix", "left").join(titles, "norm", "left").join(years.select(F.col("document_id").alias("_d"), "years"), F.col("ts.document_id") == F.col("_d"), "left")
    by_title = F.col("ts").isNotNull() & year_matches(F.col("year"), F.col("years"))
    hit = F.when(F.col("s").isNotNull(), F.struct(F.col("s.document_id").alias("document_id"), F.col("s.key").alias("twin_of"), F.lit("mathnet-doi").alias("twin_rule"))).when(by_title, F.struct(F.col("ts.document_id").alias("document_id"), F.col("ts.key").alias("twin_of"), F.lit("title+year").alias("twin_rule")))
    return rows.withColumn("hit", hit).filter("hit IS NOT NULL").select("key", "hit.*")

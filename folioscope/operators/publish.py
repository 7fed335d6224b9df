"""The public cut: which documents, pages, works, edges and journal rows may leave,
and which columns of them.  Unknown classifications are refused, never guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The closed vocabularies of publication.
FULL, METADATA, INTERNAL, EXCLUDED = "full-text", "metadata-only", "internal", "excluded"
DISTRIBUTIONS = (FULL, METADATA, INTERNAL, EXCLUDED)
SHIPPED = (FULL, METADATA, INTERNAL)
CONTENT = (FULL, INTERNAL)
MODES = ("full-skeleton", "topology-only", "none")
JOURNAL_KEYS = ("frontier_key", "candidate_key", "node_key")
WORK_CONTENT = ("abstract", "evidence")
JOURNAL_CONTENT = ("reason",)


def shipped(distribution: Column) -> Column:
    return F.coalesce(distribution.isin(*SHIPPED), F.lit(False))


def full_content(distribution: Column) -> Column:
    return F.coalesce(distribution.isin(*CONTENT), F.lit(False))


def unclassified(documents: DataFrame) -> DataFrame:
    missing = F.col("legal_class").isNull() | F.col("public_distribution").isNull() | F.col("legal_note").isNull()
    bad = documents.filter(missing | ~F.col("public_distribution").isin(*DISTRIBUTIONS))
    return bad.select("id", F.coalesce("legal_class", F.lit("")).alias("legal_class"), F.coalesce("public_distribution", F.lit("")).alias("public_distribution")).orderBy("id")


def require_classified(documents: DataFrame) -> None:
    bad = unclassified(documents).limit(20).collect()
    if bad:
        raise ValueError(f"documents without a usable legal classification: {[r['id'] for r in bad]}")


def require_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown publication mode {mode!r}")
    return mode


def legal_summary(documents: DataFrame) -> DataFrame:
    """Documents by class and distribution with the different notes of each, sorted."""
    by = [F.coalesce(c, F.lit("")).alias(c) for c in ("legal_class", "public_distribution")]
    notes = F.array_join(F.array_sort(F.collect_set(F.nullif("legal_note", F.lit("")))), "; ")
    return documents.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), notes.alias("notes"))


def by_distribution(documents: DataFrame) -> DataFrame:
    """Every known distribution with its number of documents, unused ones with 0."""
    known = documents.sparkSession.createDataFrame([(d,) for d in DISTRIBUTIONS], "public_distribution string")
    counts = documents.groupBy(F.coalesce("public_distribution", F.lit("")).alias("public_distribution")).agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, "public_distribution", "full_outer").fillna(0, ["n"])


def public_documents(documents: DataFrame) -> DataFrame:
    kept = documents.filter(shipped(F.col("public_distribution")))
    whole = full_content(F.col("public_distribution"))
    return kept.withColumns({c: F.when(whole, F.col(c)) for c in ("source_blob", "source_sha256") if c in kept.columns})


def public_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages of shipped documents; bodies only where the whole content ships."""
    some = documents.filter(shipped(F.col("public_distribution"))).select(F.col("id").alias("document_id"), full_content(F.col("public_distribution")).alias("_whole"))
    return pages.join(some, "document_id").withColumn("body", F.when(F.col("_whole"), F.col("body")).otherwise("")).drop("_whole")


def public_works(works: DataFrame, documents: DataFrame, mode: str) -> DataFrame:
    """Works without a document or with a shipped one; content columns as typed nulls
    unless the mode is the one declared to carry them."""
    if require_mode(mode) == "none":
        return works.limit(0)
    ships = documents.filter(shipped(F.col("public_distribution"))).select(F.col("id").alias("_d")).distinct()
    free = works.filter("document_id IS NULL")
    bound = works.filter("document_id IS NOT NULL").join(ships, works["document_id"] == F.col("_d"), "left_semi")
    both = free.unionByName(bound)
    if mode == "full-skeleton":
        return both
    return both.withColumns({c: F.lit(None).cast(both.schema[c].dataType) for c in WORK_CONTENT if c in both.columns})


def public_edges(cites: DataFrame, kept_works: DataFrame) -> DataFrame:
    """Edges with both ends among the works that ship."""
    ids = kept_works.select(F.col("id").alias("_i"))
    return cites.join(ids, cites["citing"] == F.col("_i"), "left_semi").join(ids, cites["cited"] == F.col("_i"), "left_semi")


def cut_names(works: DataFrame, documents: DataFrame) -> DataFrame:
    """Names that must not appear: ids of documents that don't ship, keys of their works."""
    cut = documents.filter(~shipped(F.col("public_distribution"))).select(F.col("id").cast("string").alias("ref"))
    keys = works.join(cut, works["document_id"].cast("string") == cut["ref"], "left_semi").select(F.col("key").alias("ref"))
    return cut.union(keys).distinct()


def naming_rows(journal: DataFrame, names: DataFrame) -> DataFrame:
    """Ids of journal rows that hold one of the names in any key column: one equi-join
    over the stacked columns in place of an OR."""
    stacked = journal.select("id", F.explode(F.array(*(F.col(c).cast("string") for c in JOURNAL_KEYS))).alias("ref")).filter("ref IS NOT NULL")
    return stacked.join(names, "ref", "left_semi").select("id").distinct()


def public_journal(journal: DataFrame, works: DataFrame, documents: DataFrame, mode: str = "full-skeleton") -> DataFrame:
    """Journal rows that name nothing the cut removed; prose only in the full mode."""
    if require_mode(mode) == "none":
        return journal.limit(0)
    kept = journal.join(naming_rows(journal, cut_names(works, documents)), "id", "left_anti")
    if mode == "full-skeleton":
        return kept
    return kept.withColumns({c: F.lit(None).cast(kept.schema[c].dataType) for c in JOURNAL_CONTENT if c in kept.columns})


def leak_sample(rows: DataFrame, leaks: Column, key: str, limit: int = 20) -> tuple[int, list]:
    """Exact number of leaking rows and the first of them."""
    bad = rows.filter(leaks)
    return bad.count(), [r[0] for r in bad.select(key).orderBy(key).limit(limit).collect()]


def manifest_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) counted from what is written."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

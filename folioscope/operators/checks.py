"""Integrity checks.  A check is a DataFrame of violations (check, subject, detail);
``verdicts`` turns checks into (name, ok, detail) rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, check: str, subject: Column, detail: Column | None = None) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def duplicate_keys(rows: DataFrame, keys: list[str], check: str = "duplicate-key") -> DataFrame:
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return violations(twice, check, F.concat_ws("|", *keys), F.col("n"))


def orphans(rows: DataFrame, column: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    known = parent.select(F.col(parent_key).alias("_p"))
    bad = rows.filter(F.col(column).isNotNull()).join(known, rows[column] == F.col("_p"), "left_anti").select(column).distinct()
    return violations(bad, check, F.col(column))


def outside_vocabulary(rows: DataFrame, column: str, allowed: Iterable[str], check: str) -> DataFrame:
    bad = rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return violations(bad, check, F.col(column), F.col("n"))


def breaches(rows: DataFrame, holds: Column, subject: Column, check: str) -> DataFrame:
    return violations(rows.filter(~F.coalesce(holds, F.lit(False))), check, subject)


def work_constraints(works: DataFrame) -> DataFrame:
    ours = (F.col("kind") != "our-document") | F.col("document_id").isNotNull()
    excluded = (F.col("kind") != "excluded") | F.col("exclusion_reason").isNotNull()
    return breaches(works, ours, F.col("key"), "our-document-has-document").unionByName(breaches(works, excluded, F.col("key"), "excluded-has-reason"))


def unplaced_documents(documents: DataFrame, works: DataFrame, journal: DataFrame, source_dir: str) -> DataFrame:
    """Documents of the tree that are neither in the graph nor known to be missing."""
    due = documents.filter((F.col("source_dir") == source_dir) & (F.col("extraction_state") != "metadata"))
    placed = works.filter("kind = 'our-document'").select(F.col("document_id").cast("string").alias("_d"))
    missing = journal.filter("action = 'seed-missing'").select(F.col("frontier_key").cast("string").alias("_d"))
    return due.join(placed.union(missing).distinct(), due["id"].cast("string") == F.col("_d"), "left_anti").select("id")


def dangling_evidence(runs: DataFrame, documents: DataFrame) -> DataFrame:
    """(run_id, document_id) for documents a run cites that aren't there."""
    each = runs.select("run_id", F.explode("evidence_docs").alias("document_id"))
    return each.join(documents.select(F.col("id").alias("document_id")), "document_id", "left_anti").select("run_id", "document_id").distinct()


def no_semantic_key(rows: DataFrame, text: Column) -> DataFrame:
    """How many rows have text and no vector."""
    return rows.filter((F.trim(text) != "") & F.col("embedding").isNull()).agg(F.count(F.lit(1)).alias("n"))


def self_loops(cites: DataFrame) -> DataFrame:
    return cites.filter("citing = cited").select(F.col("citing").alias("id")).distinct()


def no_evidence(works: DataFrame) -> DataFrame:
    return works.filter("evidence IS NULL").select("key")


def indexed_without_external(works: DataFrame, documents: DataFrame, external_dir: str) -> DataFrame:
    there = documents.filter(F.col("source_dir") == external_dir).select(F.col("id").alias("_d"))
    return works.filter("kind = 'indexed'").join(there, works["document_id"] == F.col("_d"), "left_anti").select("key")


def completeness(files: DataFrame, documents: DataFrame, listed: DataFrame) -> DataFrame:
    """A problem per row (id, problem).

    files (id, kind, path, pages, sha256): every file on disk.  ``kind`` is "exclude",
    "unclassified" (named by its path) or one that is included; ``pages`` is null where
    a file has no count of its own, and its document then needs one page at least.
    documents (id, pages_count, source_path, source_sha256, source_url, has_blob): the
    hash is held against the file at ``source_path``.  listed (id): documents whose index
    row has a link."""
    included = files.filter(~F.col("kind").isin("exclude", "unclassified")).select(F.col("id").alias("f_id"), "pages")
    both = included.join(documents.select("id", "pages_count"), F.col("f_id") == F.col("id"), "full_outer")
    of_files = F.when(F.col("id").isNull(), "not-indexed").when(F.col("f_id").isNull(), "phantom-row")
    of_files = of_files.when(F.col("pages") != F.col("pages_count"), "page-count").when(F.col("pages").isNull() & (F.col("pages_count") < 1), "empty-metadata")
    on_disk = files.select(F.col("path").alias("source_path"), F.col("sha256").alias("f_sha"), F.lit(True).alias("there"))
    own = documents.join(included.select(F.col("f_id").alias("id")).distinct(), "id", "left_semi").join(on_disk, "source_path", "left")
    own = own.join(listed.select("id", F.lit(True).alias("listed")).distinct(), "id", "left")
    of_source = F.when(F.col("there").isNull(), "broken-path").when(~F.col("has_blob"), "no-blob").when(~F.col("f_sha").eqNullSafe(F.col("source_sha256")), "hash-mismatch")
    no_url = F.when(F.col("listed") & (F.coalesce("source_url", F.lit("")) == ""), "no-url")
    unknown = files.filter("kind = 'unclassified'").select(F.col("path").cast("string").alias("id"), F.lit("unclassified").alias("problem"))
    out = unknown.unionByName(both.select(F.coalesce("f_id", "id").cast("string").alias("id"), of_files.alias("problem")).filter("problem IS NOT NULL"))
    return out.unionByName(own.select(F.col("id").cast("string").alias("id"), F.explode(F.array_compact(F.array(of_source, no_url))).alias("problem")))


def compare_counts(declared: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """Rows on which two censuses differ, absent ones as null, in both directions."""
    a, b = declared.select(key, F.col(value).alias("declared")), actual.select(key, F.col(value).alias("actual"))
    return a.join(b, key, "full_outer").filter(~F.col("declared").eqNullSafe(F.col("actual")))


def set_agreement(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    a, b = left.select(key).distinct().withColumn("_l", F.lit(True)), right.select(key).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_r").isNull(), "only-left").when(F.col("_l").isNull(), "only-right")
    return a.join(b, key, "full_outer").select(key, side.alias("side")).filter("side IS NOT NULL")


def verdicts(checks: dict[str, DataFrame | None]) -> DataFrame:
    """(name, ok, detail): ok is null for a check that was skipped (None)."""
    spark = next(c for c in checks.values() if c is not None).sparkSession
    rows = None
    for name, df in checks.items():
        if df is None:
            row = spark.createDataFrame([(name, None, "skipped")], "name string, ok boolean, detail string")
        else:
            row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), (F.col("n") == 0).alias("ok"), F.concat(F.col("n").cast("string"), F.lit(" violations")).alias("detail"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def gates(steps: list[tuple[str, bool, str]]) -> list[tuple[str, bool | None, str]]:
    """Manifest gates in order: after the first that fails, the rest are not tried."""
    out, open_ = [], True
    for name, ok, detail in steps:
        out.append((name, ok, detail) if open_ else (name, None, "not reached"))
        open_ = open_ and ok
    return out


def probe_verdict(rank: int | None, reference_rank: int, drift: float, margin: float, tolerance: float = 1e-3) -> tuple[bool, str]:
    """A vector probe passes if its rank slipped by at most one, its distance by at
    most the tolerance, and the margin to the runner-up isn't within it."""
    if rank is None:
        return False, "absent"
    if rank > reference_rank + 1:
        return False, f"rank {rank} after {reference_rank}"
    if abs(drift) > tolerance:
        return False, f"distance drifted by {drift}"
    if 0 < margin <= tolerance:
        return False, f"margin {margin} is within tolerance"
    return True, "ok"


def drift(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Largest shift of rank (absolute and signed) and of distance between two rankings."""
    b = before.select(key, F.col("rank").alias("r0"), F.col("distance").alias("d0"))
    both = b.join(after, key)
    shift = F.col("rank") - F.col("r0")
    return both.agg(F.max(F.abs(shift)).alias("max_shift"), F.max(shift).alias("max_signed"), F.max(F.abs(F.col("distance") - F.col("d0"))).alias("max_distance"))

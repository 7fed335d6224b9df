"""Checks a package must pass before it is handed on: what a dump holds against what its
manifest declares.  Row checks return violations (check, subject, detail), so nothing of
the size of the corpus comes to the driver; facts about the manifest itself, which is one
small document, are plain values.  ``checks.verdicts`` turns either into a report."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.checks import violations

# The classes of distribution, those with full content, and package names.
FULL_CONTENT, STRIPPED = ("full-text", "internal"), "metadata-only"
PACKAGE = re.compile(r"kb-(?P<profile>[a-z]+)-[0-9]{8}\.tar\.zst")


def classification_complete(listed: DataFrame, documents: DataFrame, shipped: Iterable[str]) -> DataFrame:
    """listed (id, distribution): every document of the dump is listed once, under a class,
    and the dump holds as many documents as the shipped classes list."""
    named = listed.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count("distribution").alias("classed"))
    twice = violations(named.filter("n > 1"), "listed-twice", F.col("id"), F.col("n"))
    without = violations(named.filter("classed < n"), "unclassified", F.col("id"))
    want = listed.filter(F.col("distribution").isin(*shipped)).select("id").distinct()
    there = documents.select("id").distinct()
    unlisted = violations(there.join(want, "id", "left_anti"), "not-listed", F.col("id"))
    lost = violations(want.join(there, "id", "left_anti"), "not-dumped", F.col("id"))
    return twice.unionByName(without).unionByName(unlisted).unionByName(lost)


def excluded_absent(listed: DataFrame, documents: DataFrame, pages: DataFrame, shipped: Iterable[str]) -> DataFrame:
    """No row and no page of a document whose class isn't shipped."""
    out = listed.filter(~F.coalesce(F.col("distribution").isin(*shipped), F.lit(False))).select("id").distinct()
    rows = violations(documents.select("id").distinct().join(out, "id", "left_semi"), "excluded-document", F.col("id"))
    paged = pages.select(F.col("document_id").alias("id")).distinct()
    return rows.unionByName(violations(paged.join(out, "id", "left_semi"), "excluded-pages", F.col("id")))


def _content(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, blob, body): whether a document has a source file and any page text."""
    text = pages.groupBy(F.col("document_id").alias("id")).agg(F.max(F.coalesce(F.col("body") != "", F.lit(False))).alias("body"))
    blobs = documents.groupBy("id").agg(F.max(F.col("source_blob").isNotNull()).alias("blob"))
    return blobs.join(text, "id", "full_outer").fillna(False, ["blob", "body"])


def metadata_only_stripped(listed: DataFrame, documents: DataFrame, pages: DataFrame) -> DataFrame:
    """A metadata-only document ships neither its source file nor page text."""
    mine = listed.filter(F.col("distribution") == STRIPPED).select("id").distinct()
    found = _content(documents, pages).join(mine, "id", "left_semi")
    blob = violations(found.filter("blob"), "blob-of-metadata-only", F.col("id"))
    return blob.unionByName(violations(found.filter("body"), "text-of-metadata-only", F.col("id")))


def full_content_intact(listed: DataFrame, documents: DataFrame, pages: DataFrame) -> DataFrame:
    """A document of full content ships both."""
    mine = listed.filter(F.col("distribution").isin(*FULL_CONTENT)).select("id").distinct()
    found = mine.join(_content(documents, pages), "id", "left").fillna(False, ["blob", "body"])
    blob = violations(found.filter(~F.col("blob")), "blob-missing", F.col("id"))
    return blob.unionByName(violations(found.filter(~F.col("body")), "text-missing", F.col("id")))


def page_tally(pages: DataFrame) -> DataFrame:
    """One row: pages, and pages without an embedding."""
    return pages.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("embedding").isNull()).alias("no_embedding"))


def pages_embedded(pages: DataFrame, declared: int) -> DataFrame:
    """As many pages as declared, all with an embedding."""
    t = page_tally(pages)
    count = violations(t.filter(F.col("rows") != declared), "page-count", F.lit("pages"), F.col("rows"))
    return count.unionByName(violations(t.filter("no_embedding > 0"), "not-embedded", F.lit("pages"), F.col("no_embedding")))


def columns_classified(columns: DataFrame, classes: DataFrame) -> DataFrame:
    """columns (table, column) of a dump against classes (table, column, class): every table
    and every column is named there.  Generated columns are in no class and so are refused."""
    tables = classes.select("table").distinct()
    strange = violations(columns.select("table").distinct().join(tables, "table", "left_anti"), "unknown-table", F.col("table"))
    known = columns.join(tables, "table", "left_semi").join(classes.select("table", "column"), ["table", "column"], "left_anti")
    return strange.unionByName(violations(known, "unknown-column", F.concat_ws(".", "table", "column")))


def no_generated_columns(columns: DataFrame, generated: DataFrame) -> DataFrame:
    """No column (table, column) that the store computes itself is in the dump."""
    return violations(columns.join(generated, ["table", "column"], "left_semi"), "generated-column", F.concat_ws(".", "table", "column"))


def counts_match_mode(ships: bool, declared: dict[str, int], found: DataFrame) -> DataFrame:
    """found (table, rows): under a mode that ships no graph none of its tables is there;
    otherwise all are, with the declared number of rows."""
    if not ships:
        return violations(found.filter(F.col("table").isin(*declared)), "shipped-table", F.col("table"), F.col("rows"))
    want = found.sparkSession.createDataFrame([(t, n) for t, n in declared.items()], "table string, want long")
    both = want.join(found, "table", "left")
    return violations(both.filter(~F.coalesce(F.col("rows") == F.col("want"), F.lit(False))), "row-count", F.col("table"), F.col("rows"))


def policy_problems(block: dict, modes: Iterable[str], approved_by: str | None = None) -> list[str]:
    """What is wrong with a policy block: unknown mode, no owner, an override nobody signed."""
    out = []
    if block.get("mode") not in set(modes):
        out.append(f"unknown mode {block.get('mode')!r}")
    if not (block.get("owner") or "").strip():
        out.append("no owner")
    if block.get("override") and block.get("approved_by") != approved_by:
        out.append("override without approval")
    return out


def sets_agree(**sides: Iterable[str]) -> list[str]:
    """Names that some side has and another lacks, as text; empty where all sides are one set."""
    known = {k: set(v) for k, v in sides.items()}
    every = set().union(*known.values())
    return [f"{name}: not in {side}" for name in sorted(every) for side, has in known.items() if name not in has]


def bundled_files(declared: DataFrame, present: DataFrame, allowed: Iterable[str] = ()) -> DataFrame:
    """(path, sha256) on both sides: files missing, changed, or there without being declared
    (``allowed`` ones may be)."""
    d, p = declared.withColumnRenamed("sha256", "_d"), present.withColumnRenamed("sha256", "_p")
    both = d.join(p, "path", "full_outer")
    missing = violations(both.filter("_p IS NULL"), "missing-file", F.col("path"))
    changed = violations(both.filter("_d != _p"), "changed-file", F.col("path"))
    extra = both.filter("_d IS NULL").filter(~F.col("path").isin(*allowed)) if list(allowed) else both.filter("_d IS NULL")
    return missing.unionByName(changed).unionByName(violations(extra, "extra-file", F.col("path")))


def newest_package(names: DataFrame, profile: str | None = None) -> DataFrame:
    """names (name): the last package by name, of one profile if given; no rows without one."""
    fits = names.filter(F.col("name").rlike(f"^{PACKAGE.pattern.replace('(?P<profile>[a-z]+)', profile or '[a-z]+')}$"))
    return fits.agg(F.max("name").alias("name")).filter("name IS NOT NULL")


def models_agree(declared: DataFrame, served: DataFrame) -> DataFrame:
    """(model, digest) declared against served; a name without a tag means its latest one."""
    full = lambda c: F.when(F.instr(c, ":") > 0, F.col(c)).otherwise(F.concat(c, F.lit(":latest")))
    want = declared.select(full("model").alias("model"), F.col("digest").alias("want"))
    have = served.groupBy(full("model").alias("model")).agg(F.min("digest").alias("have"))
    both = want.join(have, "model", "left")
    return violations(both.filter("have IS NULL OR have != want"), "model-digest", F.col("model"), F.coalesce("have", F.lit("not served")))


def blobs_intact(documents: DataFrame) -> DataFrame:
    """Source files whose digest isn't the recorded one."""
    bad = documents.filter(F.col("source_blob").isNotNull() & ~F.coalesce(F.sha2("source_blob", 256) == F.col("source_sha256"), F.lit(False)))
    return violations(bad, "blob-digest", F.col("id"))


def restore_order(tables: list[str], references: Iterable[tuple[str, str]]) -> list[str]:
    """``tables`` so that each follows those it refers to (child, parent), otherwise in the
    order given; ValueError where references form a circle."""
    waits = {t: {b for a, b in references if a == t and b != t and b in tables} for t in tables}
    out: list[str] = []
    while waits:
        ready = next((t for t, parents in waits.items() if parents <= set(out)), None)
        if ready is None:
            raise ValueError("references form a circle among " + ", ".join(sorted(waits)))
        out.append(ready)
        del waits[ready]
    return out

"""Measurement runs and their rows, manifests, loads of source files, and rules of values.
Tables go in and the new tables come out; ``snapshots.publish`` makes them current."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.stats import hub_stats, suggest_tau


class NothingToMeasure(Exception):
    """An empty input is no measurement of nothing."""


def establish_run(runs: DataFrame, children: dict[str, DataFrame], run: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Runs with ``run`` (one row, spike) in place of the run of its spike, under a new id,
    and the child tables (run_id) without the rows of the old one."""
    spike = run.select("spike")
    old = runs.join(spike, "spike", "left_semi").select(F.col("id").alias("run_id"))
    number = runs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    fresh = run.crossJoin(F.broadcast(number)).withColumn("id", F.col("_last") + 1).drop("_last")  # one row beside one row
    kept = runs.join(spike, "spike", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True), {t: c.join(old, "run_id", "left_anti") for t, c in children.items()}


def amend_run(runs: DataFrame, spike: str, fields: dict[str, Column]) -> DataFrame:
    """The run of a spike with other values; its id, and so its rows, stay."""
    mine = F.col("spike") == spike
    return runs.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in fields.items()})


def append_rows(rows: DataFrame, run_id: int, more: DataFrame) -> tuple[DataFrame, int]:
    """The table with the rows of a run added, and their number."""
    fresh = more.withColumn("run_id", F.lit(run_id).cast(rows.schema["run_id"].dataType))
    return rows.unionByName(fresh.select([c for c in rows.columns if c in fresh.columns]), allowMissingColumns=True), more.count()


def record_calibration(scores: DataFrame, runs: DataFrame, thresholds: DataFrame, spike: str = "calibration") -> tuple[DataFrame, DataFrame, float | None]:
    """Runs and threshold rows with a new calibration (scores: candidate_key, score, ...),
    and the threshold it suggests."""
    if not scores.limit(1).count():
        raise NothingToMeasure("no candidates to calibrate on")
    tau = suggest_tau(scores)
    run = scores.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(spike).alias("spike"), "n", F.lit(tau).cast("double").alias("tau"))
    runs, children = establish_run(runs, {"thresholds": thresholds}, run)
    number = runs.filter(F.col("spike") == spike).first()["id"]
    table, _ = append_rows(children["thresholds"], number, scores)
    return runs, table, tau


def record_hub_report(batches: DataFrame, works: DataFrame, cap: int) -> DataFrame:
    """Statistics of hubs; refused where no batch was ever read."""
    if not batches.limit(1).count():
        raise NothingToMeasure("no batch in the cache")
    return hub_stats(works, cap)


def load_blobs(documents: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents (id, source_path, source_sha256, source_blob) with the files (path, content)
    whose digest differs, and how many were loaded, unchanged and missing."""
    have = files.select(F.col("path").alias("source_path"), "content", F.sha2("content", 256).alias("_sha"))
    both = documents.join(have, "source_path", "left")
    state = F.when(F.col("_sha").isNull(), "missing").when(F.col("_sha").eqNullSafe(F.col("source_sha256")), "unchanged").otherwise("loaded")
    both = both.withColumn("_state", state)
    changed = F.col("_state") == "loaded"
    out = both.withColumns({"source_blob": F.when(changed, F.col("content")).otherwise(F.col("source_blob")), "source_sha256": F.when(changed, F.col("_sha")).otherwise(F.col("source_sha256"))})
    return out.select(*documents.columns), both.groupBy(F.col("_state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def ensure_rule(rules: DataFrame, table: str, name: str, predicate: str, rows: DataFrame) -> tuple[DataFrame, str]:
    """rules (table, name, predicate) with this rule, and whether it was kept, replaced or
    added.  Rows that break a new rule are an error, and then nothing changes."""
    old = rules.filter((F.col("table") == table) & (F.col("name") == name)).first()
    if old is not None and old["predicate"] == predicate:
        return rules, "kept"
    if rows.filter(~F.coalesce(F.expr(predicate), F.lit(True))).limit(1).count():
        raise ValueError(f"rows of {table} break {name}")
    others = rules.filter(~((F.col("table") == table) & (F.col("name") == name)))
    fresh = rules.sparkSession.createDataFrame([(table, name, predicate)], "table string, name string, predicate string")
    return others.unionByName(fresh), "added" if old is None else "replaced"


def ensure_vocabulary(rules: DataFrame, table: str, column: str, words: list[str], rows: DataFrame) -> tuple[DataFrame, str]:
    """A rule that a column holds one of these words, in one spelling whatever their order."""
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words))
    return ensure_rule(rules, table, f"{table}_{column}_vocabulary", f"{column} IN ({listed})", rows)


def stamp_manifest(manifest: dict, written: DataFrame, kinds: DataFrame) -> dict:
    """``manifest`` with the numbers of what was written: written (schema, table, rows), kinds
    (kind, n).  A table that wasn't written counts 0, so the key is always there."""
    counts = {(r["schema"], r["table"]): r["rows"] for r in written.collect()}  # one row per table
    out = json.loads(json.dumps(manifest))
    for schema in ("corpus", "citation"):
        rows = {t: n for (s, t), n in sorted(counts.items()) if s == schema}
        out.setdefault(schema, {})["table_rows"] = rows
    out["documents_count"], out["pages_count"] = (counts.get(("corpus", t), 0) for t in ("documents", "pages"))
    out["citation"] |= {"work_count": counts.get(("citation", "work"), 0), "cites_count": counts.get(("citation", "cites"), 0)}
    out["citation"]["work_by_kind"] = {r["kind"]: r["n"] for r in kinds.orderBy("kind").collect()}  # a closed vocabulary
    return out


def markdown_report(title: str, rows: DataFrame, columns: list[str], limit: int = 200, old: str = "", marker: str = "## Notes") -> str:
    """A report table of at most ``limit`` rows; what a person wrote below ``marker`` in the
    old report is carried over."""
    from folioscope.functions.records import report_cell

    cells = rows.select(*(report_cell(F.col(c).cast("string")).alias(c) for c in columns)).limit(limit).collect()
    lines = [f"# {title}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(r) + " |" for r in cells), ""]
    tail = old[old.index(marker) :] if marker in old else ""
    return "\n".join(lines) + ("\n" + tail if tail else "")

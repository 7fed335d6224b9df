"""Sources that are files of other kinds: page text from an external tool, OCR layers,
metadata documents, cached responses, dump statements and catalogs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def extracted_texts(files: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """files (path, content), as ``binaryFile`` reads them -> (path, text).  ``extract`` runs
    on the executors, a file at a time; whatever it raises ends the job, so a file is never
    there in part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([extract(content.as_py())], pa.string())], names=["path", "text"])

    return files.select("path", "content").mapInArrow(run, "path string, text string")


def ocr_pages(texts: DataFrame, declared: DataFrame) -> DataFrame:
    """texts (path, text with a form feed after each page) -> (path, page_number, body);
    ValueError where the number of pages isn't the one the file itself declares (path, pages)."""
    parts = F.split("text", "\f")
    pages = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    cut = texts.select("path", pages.alias("p"))
    bad = cut.join(declared, "path", "left").filter(~F.coalesce(F.size("p") == F.col("pages"), F.lit(False))).select("path").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0][0]}: pages and declared pages differ")
    return cut.select("path", F.posexplode("p").alias("n", "body")).select("path", (F.col("n") + 1).alias("page_number"), "body")


def document_per_file(spark: SparkSession, paths: str) -> DataFrame:
    """Each text file is a document of one page: (id, page_number, body)."""
    whole = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
    name = F.element_at(F.split("path", "/"), -1)
    return whole.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("id"), F.lit(1).alias("page_number"), "body")


def cached(entries: DataFrame, names: DataFrame, floor: int = 0) -> tuple[DataFrame, DataFrame]:
    """entries (name, body, at), names (name): what the cache holds of the names, newest
    first by ``at``, and the names it doesn't.  A body of ``floor`` bytes or less is a miss."""
    good = entries.filter(F.octet_length("body") > floor).groupBy("name").agg(F.max_by("body", "at").alias("body"))
    wanted = names.select("name").distinct()
    return good.join(wanted, "name", "left_semi"), wanted.join(good, "name", "left_anti")


_NAME = r"[a-z_][a-z0-9_]*"


def statements(lines: DataFrame) -> DataFrame:
    """lines (ordinal, line) outside data blocks -> (ordinal, kind, schema, table, column):
    schemas named, sequences owned, and sequences set, which a sequence's name is followed
    back to its column for."""
    def hit(pattern: str, *groups: int) -> list:
        return [F.nullif(F.regexp_extract("line", pattern, g), F.lit("")) if g else F.lit(None).cast("string") for g in groups]

    qualified = rf"^(?:CREATE TABLE|CREATE SEQUENCE|COPY|ALTER TABLE(?: ONLY)?) ({_NAME})\."
    schema = F.coalesce(*hit(rf"^CREATE SCHEMA (?:IF NOT EXISTS )?({_NAME});", 1), *hit(qualified, 1))
    owned = rf"^ALTER SEQUENCE ({_NAME})\.({_NAME}) OWNED BY ({_NAME})\.({_NAME})\.({_NAME});"
    by_column = rf"^SELECT (?:pg_catalog\.)?setval\(pg_get_serial_sequence\('({_NAME})\.({_NAME})', '({_NAME})'\)"
    by_name = rf"^SELECT (?:pg_catalog\.)?setval\('({_NAME})\.({_NAME})'"
    row = lambda kind, s, t, c: lines.select("ordinal", F.lit(kind).alias("kind"), s.alias("schema"), t.alias("table"), c.alias("column")).filter("schema IS NOT NULL")
    none = F.lit(None).cast("string")
    names = lines.select(*(c.alias(n) for c, n in zip(hit(owned, 1, 2, 3, 4, 5), ("_ss", "_sn", "schema", "table", "column"), strict=True))).filter("_ss IS NOT NULL")
    named = lines.select("ordinal", *(c.alias(n) for c, n in zip(hit(by_name, 1, 2), ("_ss", "_sn"), strict=True))).filter("_ss IS NOT NULL")
    followed = named.join(names, ["_ss", "_sn"]).select("ordinal", F.lit("sequence-set").alias("kind"), "schema", "table", "column")
    out = row("schema", schema, none, none).unionByName(row("sequence-owned", *hit(owned, 3, 4, 5)))
    return out.unionByName(row("sequence-set", *hit(by_column, 1, 2, 3))).unionByName(followed)


def catalog_columns(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type) of tables by name."""
    spark = next(iter(frames.values())).sparkSession
    rows = [(t, i + 1, c, kind) for t, df in frames.items() for i, (c, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def absent_tables(frames: dict[str, DataFrame | None], wanted: list[str]) -> list[str]:
    """Wanted tables that aren't there: a state to report, not an error."""
    return [t for t in wanted if frames.get(t) is None]


def scalar(df: DataFrame):
    """The one value of a result: None without rows; ValueError for more than one row or column."""
    row = only_row(df)
    if row is None:
        return None
    if len(row) != 1:
        raise ValueError(f"{len(row)} columns where one was asked for")
    return row[0]


def only_row(df: DataFrame, columns: int | None = None):
    """The one row of a result, or None; ValueError for more rows or other than ``columns``."""
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("more than one row")
    if rows and columns is not None and len(rows[0]) != columns:
        raise ValueError(f"{len(rows[0])} columns where {columns} were asked for")
    return rows[0] if rows else None

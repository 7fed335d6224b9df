"""Text inputs: page splits, transcribed page files, registries, indexes and manifests."""

from __future__ import annotations

import html as html_lib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The columns of the registry of external sources, and its file types.
REGISTRY_COLUMNS = ("filename", "source_tier", "source_url", "legal_note", "bibliography", "reason")
SUFFIXES = (".pdf", ".djvu", ".md", ".txt")


def split_pages(documents: DataFrame, id_col: str, text: Column, by: str = "\f") -> DataFrame:
    """(document_id, page_number, body): one row a page, from 1; one blank page at the
    very end is dropped."""
    parts = F.split(text, by)
    last = F.trim(F.element_at(parts, -1), F.lit(" \t\r\n"))
    kept = F.when((F.size(parts) > 1) & (last == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return documents.select(F.col(id_col).alias("document_id"), F.posexplode(kept).alias("p", "body")).select("document_id", (F.col("p") + 1).alias("page_number"), "body")


def transcribed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Files <stem>-NN.txt: number from the name, body trimmed, blank pages skipped."""
    files = spark.read.text(f"{folder}/*.txt", wholetext=True).withColumn("name", F.substring_index(F.col("_metadata.file_path"), "/", -1))
    rows = files.select(F.regexp_extract("name", r"^(.*)-(\d+)\.txt$", 1).alias("document_id"), F.regexp_extract("name", r"-(\d+)\.txt$", 1).alias("n"), F.regexp_replace("value", r"^\s+|\s+$", "").alias("body"))
    return rows.filter("n != '' AND body != ''").select("document_id", F.col("n").cast("int").alias("page_number"), "body")


def manifest_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path).select(F.explode("documents").alias("d")).select("d.*")


def index_urls(lines: DataFrame) -> DataFrame:
    """(stem, url) from index table rows (number, value); the last row of a stem wins."""
    cells = F.transform(F.split("value", r"\|"), lambda c: F.trim(c))
    rows = lines.select("number", cells.alias("c")).filter((F.size("c") >= 4) & F.get("c", 1).rlike("^[0-9]{4}$"))
    file = F.replace(F.get("c", 2), F.lit("`"), F.lit(""))
    links = F.filter("c", lambda c: c.rlike(r"^\[[^\]]+\]\(https?://"))
    link = F.regexp_replace(F.substring_index(F.get(links, 0), "](", -1), r"\).*$", "")
    got = rows.select("number", file.alias("path"), link.alias("url")).filter(F.col("path").endswith(".pdf") & F.col("url").isNotNull())
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.pdf$", "")
    return got.groupBy(stem.alias("stem")).agg(F.max_by("url", "number").alias("url"))


def parse_registry(lines: DataFrame, columns: tuple[str, ...] = REGISTRY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Rows and problems of a pipe table (number, value).  Problems name the line: wrong
    number of cells, bad suffix, sub-folder, URL, blank cell, file given twice."""
    bare = F.trim(F.regexp_replace(F.trim("value"), r"^\||\|$", ""))
    cells = F.transform(F.split(bare, r"\|"), lambda c: F.trim(c))
    table = lines.filter(F.ltrim("value").startswith("|")).select("number", cells.alias("cells"))
    head = F.array(*map(F.lit, columns))
    start = table.filter(F.col("cells") == head).agg(F.min("number").alias("start"))
    data = table.join(F.broadcast(start)).filter("number > start").filter(~F.forall("cells", lambda c: c.rlike("^[-: ]*$"))).drop("start")
    named = data.filter(F.size("cells") == len(columns)).select("number", *(F.element_at("cells", i + 1).alias(c) for i, c in enumerate(columns)))
    ok_suffix = F.lit(False)
    for s in SUFFIXES:
        ok_suffix = ok_suffix | F.col("filename").endswith(s)
    tests = [(~ok_suffix, "suffix"), (F.contains("filename", F.lit("/")), "folder"), (~F.col("source_url").rlike("^https?://"), "url")]
    tests += [(F.col(c) == "", f"blank {c}") for c in columns if c not in ("filename", "source_url")]
    problem = F.array_compact(F.array(*(F.when(t, n) for t, n in tests)))
    bad = named.select("number", F.explode(problem).alias("problem"))
    bad = bad.unionByName(data.filter(F.size("cells") != len(columns)).select("number", F.lit("number of cells").alias("problem")))
    again = named.groupBy("filename").agg(F.max("number").alias("number"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("number", F.lit("given twice").alias("problem"))
    none = start.filter("start IS NULL").select(F.lit(0).cast(lines.schema["number"].dataType).alias("number"), F.lit("no header").alias("problem"))
    return named, bad.unionByName(again).unionByName(none)


def html_title(html: Column) -> Column:
    """Text of the first <title>, tags dropped, white space collapsed."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(raw, "<[^>]+>", ""), r"\s+", " "))


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """HTML character references undone; SQL has no function that knows their names."""
    return text.map(html_lib.unescape, na_action="ignore")


def quoted_titles(html: Column) -> Column:
    """Struct of the titles in curly quotes within the first <title>, blank ones left out,
    and the years named in it, sorted, each once; both empty without a <title>."""
    raw = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?s)<title>(.*?)</title>", 1)
    head = F.replace(unescaped(F.regexp_replace(raw, "<[^>]+>", "")), F.lit("\u00a0"), F.lit(" "))
    quoted = F.transform(F.regexp_extract_all(head, F.lit(r"(?s)\u201c(.*?)\u201d"), 1), lambda q: F.regexp_replace(q, r"^\s+|\s+$", ""))
    years = F.transform(F.regexp_extract_all(head, F.lit(r"\b((?:19|20)\d{2})\b"), 1), lambda y: y.cast("int"))
    return F.struct(F.filter(quoted, lambda q: q != "").alias("titles"), F.array_sort(F.array_distinct(years)).alias("years"))


def years_in(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\b(1[89]\d\d|20\d\d)\b"), 1), lambda y: y.cast("int"))))


def contributions(items: Column) -> Column:
    """Abstract from (kind, text) items: blanks out, summary before review before the
    rest, blank lines between."""
    rank = lambda k: F.when(k == "summary", 0).when(k == "review", 1).otherwise(2)
    kept = F.filter(items, lambda x: F.trim(F.coalesce(x["text"], F.lit(""))) != "")
    placed = F.transform(kept, lambda x, i: F.struct(rank(x["kind"]).alias("r"), i.alias("i"), x["text"].alias("t")))
    return F.array_join(F.transform(F.array_sort(placed), lambda x: x["t"]), "\n\n")


def blobs(spark: SparkSession, glob: str) -> DataFrame:
    """(path, source_blob, source_sha256) of binary files."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("content").alias("source_blob"), F.sha2("content", 256).alias("source_sha256"))


def records_by_ids(records: DataFrame, ids: DataFrame) -> DataFrame:
    return records.join(ids.select("id").distinct(), "id", "left_semi")


def citers_of(records: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, cited): records that refer to one of the ids, and to which."""
    return records.select("id", F.explode("refs").alias("cited")).join(ids.select(F.col("id").alias("cited")).distinct(), "cited", "left_semi").select("id", "cited").distinct()


def batch_counts(pages: DataFrame) -> DataFrame:
    """Promised counts of cached answers (name, filter, count): one per filter, that of the
    page whose name comes first; null counts as 0."""
    first = F.min_by(F.coalesce("count", F.lit(0)), "name")
    return pages.groupBy(F.coalesce("filter", F.lit("")).alias("filter")).agg(first.alias("count")).orderBy(F.col("count").desc(), "filter")


def memo_lookup(texts: DataFrame, memo: DataFrame, model: str) -> DataFrame:
    """texts (id, text) with the memoised vector of each text, null where it is new."""
    keyed = texts.withColumn("_sha", F.sha2("text", 256))
    known = memo.filter(F.col("model") == model).select(F.col("text_sha").alias("_sha"), "embedding").dropDuplicates(["_sha"])
    return keyed.join(known, "_sha", "left").drop("_sha")

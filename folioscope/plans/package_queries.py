"""Registered queries over records, runs, packages and files, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.functions import records as rec
from folioscope.functions import text as tx
from folioscope.operators import checks, merge, package_checks, runs, seeding, stats
from folioscope.plans.registry import PAGES, _pages, query
from folioscope.plans.standins import load, table, with_sql
from folioscope.sources import copy_dump, files, text_sources

# --- records ---------------------------------------------------------------------------
RECORDS = """SELECT p_partkey AS n, concat('https://openalex.org/W', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '/' ELSE '' END) AS id,
  CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat(' HTTPS://doi.org/10.1/', p_partkey, '. ') ELSE concat('http://dx.doi.org/10.2/', p_brand, ',') END AS doi,
  CASE p_partkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat(' ', p_name) END AS title, p_type AS display_name,
  concat('https://mag/', p_partkey % 100) AS mag, p_brand AS brand FROM part"""
_DOI = "rtrim(replace(replace(lower(trim(coalesce(doi, ''))), 'https://doi.org/', ''), 'http://dx.doi.org/', ''), '.,')"
_CLAIMS = f"list_sort(list_distinct([x for x in ['openalex:W' || n, 'mag:' || (n % 100), 'doi:' || nullif({_DOI}, '')] if x IS NOT NULL]))"


def _records(s, d):
    return s.sql(RECORDS.replace("FROM part", "FROM {part}"), part=table(s, d, "part"))


def _claims(s, d):
    ids = F.create_map(F.lit("mag"), F.col("mag"), F.lit("doi"), F.col("doi"))
    return _records(s, d).withColumn("ids", rec.record_ids(ids, F.col("id"), F.col("doi")))


@query("record_ids", f"WITH r AS ({RECORDS}) SELECT n, array_to_string({_CLAIMS}, ' ') AS ids FROM r")
def _(s, d):
    return _claims(s, d).select("n", F.array_join("ids", " ").alias("ids"))


@query("external_ids", f"""WITH r AS ({RECORDS}), a AS (SELECT n, unnest({_CLAIMS}) AS a FROM r)
SELECT n, split_part(a, ':', 1) AS namespace, string_agg(substr(a, strpos(a, ':') + 1), ' ' ORDER BY a) AS ids FROM a GROUP BY 1, 2""")
def _(s, d):
    groups = _claims(s, d).select("n", F.explode(rec.external_ids(F.col("ids"))).alias("namespace", "v"))
    return groups.select("n", "namespace", F.array_join("v", " ").alias("ids"))


@query("record_titles", f"""WITH r AS ({RECORDS})
SELECT n, coalesce(nullif(trim(title), ''), nullif(trim(display_name), '')) AS title,
  CASE WHEN n % 2 = 0 THEN display_name || '; ' || brand ELSE brand END AS authors FROM r""")
def _(s, d):
    author = F.struct(F.when(F.col("n") % 2 == 0, F.col("display_name")).otherwise("").alias("display_name"))
    blank = F.struct(F.struct(F.lit(None).cast("string").alias("display_name")).alias("author"), F.lit("").alias("raw_author_name"))
    first = F.struct(author.alias("author"), F.lit(None).cast("string").alias("raw_author_name"))
    second = F.struct(F.struct(F.lit("").alias("display_name")).alias("author"), F.col("brand").alias("raw_author_name"))
    authors = rec.record_authors(F.array(first, blank, second))
    return _records(s, d).select("n", rec.record_title(F.col("title"), F.col("display_name")).alias("title"), F.array_join(authors, "; ").alias("authors"))


EVIDENCE = """CASE WHEN event_id % 9 <> 0 THEN concat('{"records":[{"cited_by_count":', event_id % 11, '},{"id":"W', event_id % 5,
  '","cited_by_count":', event_id % 5, ',"referenced_works_count":', event_id % 3, '}]}') END AS evidence"""


@query("evidence_sums", f"""WITH e AS (SELECT event_id, {EVIDENCE} FROM events)
SELECT event_id, coalesce(list_sum([x::BIGINT for x in json_extract(evidence, '$.records[*].cited_by_count')]), 0)::BIGINT AS cited_by,
  coalesce(list_sum([x::BIGINT for x in json_extract(evidence, '$.records[*].referenced_works_count')]), 0)::BIGINT AS refs FROM e""")
def _(s, d):
    rows = table(s, d, "events").selectExpr("event_id", EVIDENCE).withColumn("r", rec.records_of(F.col("evidence")))
    return rows.select("event_id", rec.summed(F.col("r"), "cited_by_count").alias("cited_by"), rec.summed(F.col("r"), "referenced_works_count").alias("refs"))


@query("evidence_json", """SELECT event_id, '{"records":["r' || event_id || '"]' || CASE WHEN event_id % 2 = 0 THEN ',"relation":"cites"' ELSE '' END
  || ',"discovered_from":"W' || user_id || '"' || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"frontier_score":0.' || (event_id % 7 + 1) END || '}' AS evidence FROM events""")
def _(s, d):
    score = F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 7 + 1) / 10.0 + 1e-8)
    text = rec.evidence(
        F.array(F.concat(F.lit("r"), F.col("event_id").cast("string"))), F.when(F.col("event_id") % 2 == 0, "cites").otherwise(""),
        F.concat(F.lit("W"), F.col("user_id").cast("string")), score, F.lit(""), F.lit(None).cast("string"),
    )
    return table(s, d, "events").select("event_id", text.alias("evidence"))


CACHED = """SELECT event_id, event_id % 50 * 3 AS n, CASE event_id % 4 WHEN 0 THEN 'cites:W' WHEN 1 THEN 'referenced_works:W' WHEN 2 THEN 'openalex_id:W' ELSE 'author:A' END AS f,
  event_id % 50 AS k FROM events"""
BODY = """concat('{"meta":{"count":', n, ',"x_query":{"oql":"works","url":"https://api/works?', CASE WHEN event_id % 10 <> 9 THEN concat('filter=', f, k, '&') ELSE '' END,
  'cursor=', event_id, '"}}}')"""
_DIRECTION = "CASE event_id % 4 WHEN 0 THEN 'cites' WHEN 1 THEN 'cites' WHEN 2 THEN 'openalex_id' END"


def _index(s, d):
    rows = s.sql(CACHED.replace("FROM events", "FROM {events}"), events=table(s, d, "events")).withColumn("body", F.expr(BODY))
    return rows.select("event_id", *(c.alias(name) for name, c in rec.page_index(F.col("body")).items()))


@query("page_index", f"""WITH c AS ({CACHED}) SELECT event_id, CASE WHEN event_id % 10 = 9 THEN 'works' ELSE f || k END AS filter,
  CASE WHEN event_id % 10 <> 9 THEN {_DIRECTION} END AS direction, 'works' AS oql, n AS "count" FROM c""")
def _(s, d):
    return _index(s, d)


@query("hub_batches", f"WITH c AS ({CACHED}) SELECT f || k AS filter, min_by(n + event_id % 7, event_id) AS \"count\" FROM c WHERE event_id % 10 <> 9 AND {_DIRECTION} = 'cites' GROUP BY 1")
def _(s, d):
    pages = _index(s, d).filter("direction = 'cites'").withColumn("count", F.col("count") + F.col("event_id") % 7)
    return text_sources.batch_counts(pages.withColumnRenamed("event_id", "name"))


@query("note_directions", f"WITH c AS ({CACHED}) SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'told' ELSE {_DIRECTION} END AS direction FROM c")
def _(s, d):
    rows = s.sql(CACHED.replace("FROM events", "FROM {events}"), events=table(s, d, "events"))
    name = F.concat("f", F.col("k").cast("string"))
    return rows.select("event_id", rec.note_direction(F.lit("told"), name, F.col("event_id") % 3 == 0).alias("direction"))


@query("entry_names", "SELECT conv_id, turn, regexp_replace(concat(role, ':v', turn), '[^A-Za-z0-9._-]', '_', 'g') || '-' || sha256(text) || '.json' AS name FROM conversations WHERE text IS NOT NULL")
def _(s, d):
    model = F.concat("role", F.lit(":v"), F.col("turn").cast("string"))
    return table(s, d, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", rec.entry_name(model, F.col("text")).alias("name"))


PATHS = """SELECT o_orderkey, concat(CASE o_orderkey % 5 WHEN 0 THEN 'iis/' WHEN 1 THEN 'external/' WHEN 2 THEN 'iis/wiki/' WHEN 3 THEN 'iis/sub/' ELSE 'other/' END,
  CASE o_orderkey % 7 WHEN 0 THEN 'INDEX.md' WHEN 1 THEN 'THEMES.md' WHEN 2 THEN 'a.djvu' WHEN 3 THEN 'SOURCES.md' WHEN 4 THEN 'b.md' WHEN 5 THEN 'c.txt' ELSE 'd.pdf' END) AS p FROM orders"""


@query("path_verdicts", f"""WITH x AS ({PATHS}) SELECT o_orderkey, p, CASE WHEN p LIKE 'iis/wiki/%' THEN 'exclude' WHEN regexp_full_match(p, 'iis/[^/]+\\.pdf') THEN 'include-pdf'
  WHEN regexp_full_match(p, 'iis/[^/]+\\.djvu') THEN 'include-djvu' WHEN p IN ('iis/INDEX.md', 'iis/THEMES.md', 'external/SOURCES.md') THEN 'include-metadata'
  WHEN regexp_full_match(p, 'external/[^/]+\\.(pdf|md)') THEN 'include-external' ELSE 'unclassified' END AS verdict FROM x""")
def _(s, d):
    return s.sql(PATHS.replace("FROM orders", "FROM {orders}"), orders=table(s, d, "orders")).withColumn("verdict", rec.path_verdict(F.col("p")))


@query("report_cells", "SELECT page_id, replace(left(coalesce(html, ''), 70), '|', '\\|') AS cell FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", rec.report_cell(F.col("html")).alias("cell"))


@query("pretty_sizes", """WITH z AS (SELECT lang, sum(strlen(text))::BIGINT AS n FROM documents GROUP BY lang UNION ALL SELECT 'doc' || doc_id, strlen(text)::BIGINT FROM documents)
SELECT lang, CASE WHEN n < 10240 THEN n || ' bytes' WHEN round(n / 1024.0::DOUBLE) < 10240 THEN round(n / 1024.0::DOUBLE)::BIGINT || ' kB'
  WHEN round(n / 1048576.0::DOUBLE) < 10240 THEN round(n / 1048576.0::DOUBLE)::BIGINT || ' MB' ELSE round(n / 1073741824.0::DOUBLE)::BIGINT || ' GB' END AS size FROM z""")
def _(s, d):
    docs = table(s, d, "documents")
    size = F.octet_length("text").cast("long")
    both = docs.groupBy("lang").agg(F.sum(size).alias("n")).unionByName(docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("lang"), size.alias("n")))
    return both.select("lang", rec.pretty_size(F.col("n")).alias("size"))


@query("fresh_keys", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' - INTERVAL 90 DAY")
def _(s, d):
    return table(s, d, "orders").filter(rec.fresh(F.col("o_orderdate"), 90, F.lit("1998-01-01").cast("timestamp"))).select("o_orderkey")


@query("overlapping_runs", """WITH r AS (SELECT l_orderkey AS run, list(DISTINCT l_suppkey) AS docs FROM lineitem GROUP BY 1)
SELECT run FROM r WHERE list_has_any(docs, [1, 5, 7])""")
def _(s, d):
    sets = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("run")).agg(F.collect_set("l_suppkey").alias("docs"))
    return sets.filter(F.arrays_overlap("docs", F.array(*(F.lit(x).cast("long") for x in (1, 5, 7))))).select("run")


# --- package ---------------------------------------------------------------------------
SHIPPED = "('full-text', 'metadata-only', 'internal')"
LISTED = f"{with_sql('corpus')}, listed AS (SELECT id, public_distribution AS distribution FROM corpus UNION ALL SELECT id, public_distribution FROM corpus WHERE id % 97 = 5)"
DUMPED = f"dumped AS (SELECT id, CASE WHEN id % 3 <> 0 THEN 'x' END AS source_blob FROM corpus WHERE id % 11 <> 0 AND (coalesce(public_distribution IN {SHIPPED}, false) OR id % 13 = 0))"
TEXTS = "texts AS (SELECT id AS document_id, CASE WHEN id % 4 = 0 THEN '' ELSE 'body' END AS body FROM corpus WHERE id % 2 = 0)"


def _package(s, d):
    corpus = load(s, d, "corpus")
    listed = corpus.select("id", F.col("public_distribution").alias("distribution"))
    listed = listed.unionByName(listed.filter("id % 97 = 5"))
    dumped = corpus.filter(f"id % 11 <> 0 AND (coalesce(public_distribution IN {SHIPPED}, false) OR id % 13 = 0)")
    dumped = dumped.select("id", F.when(F.col("id") % 3 != 0, F.lit("x")).alias("source_blob"))
    texts = corpus.filter("id % 2 = 0").select(F.col("id").alias("document_id"), F.when(F.col("id") % 4 == 0, "").otherwise("body").alias("body"))
    return listed, dumped, texts


SHIP = ("full-text", "metadata-only", "internal")


@query("classification_complete", f"""{LISTED}, {DUMPED}, want AS (SELECT DISTINCT id FROM listed WHERE distribution IN {SHIPPED})
SELECT 'listed-twice' AS "check", id::VARCHAR AS subject, count(*)::VARCHAR AS detail FROM listed GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'unclassified', id::VARCHAR, '' FROM listed WHERE distribution IS NULL GROUP BY id
UNION ALL SELECT 'not-listed', id::VARCHAR, '' FROM dumped WHERE id NOT IN (SELECT id FROM want)
UNION ALL SELECT 'not-dumped', id::VARCHAR, '' FROM want WHERE id NOT IN (SELECT id FROM dumped)""")
def _(s, d):
    listed, dumped, _texts = _package(s, d)
    return package_checks.classification_complete(listed, dumped, SHIP)


@query("excluded_absent", f"""{LISTED}, {DUMPED}, {TEXTS}, gone AS (SELECT DISTINCT id FROM listed WHERE NOT coalesce(distribution IN {SHIPPED}, false))
SELECT 'excluded-document' AS "check", id::VARCHAR AS subject, '' AS detail FROM dumped WHERE id IN (SELECT id FROM gone)
UNION ALL SELECT 'excluded-pages', document_id::VARCHAR, '' FROM texts WHERE document_id IN (SELECT id FROM gone)""")
def _(s, d):
    return package_checks.excluded_absent(*_package(s, d), SHIP)


_HAS = "has AS (SELECT coalesce(a.id, b.id) AS id, coalesce(blob, false) AS blob, coalesce(body, false) AS body FROM (SELECT id, source_blob IS NOT NULL AS blob FROM dumped) a FULL JOIN (SELECT document_id AS id, body <> '' AS body FROM texts) b ON a.id = b.id)"


@query("metadata_only_stripped", f"""{LISTED}, {DUMPED}, {TEXTS}, {_HAS}, mine AS (SELECT DISTINCT id FROM listed WHERE distribution = 'metadata-only')
SELECT 'blob-of-metadata-only' AS "check", id::VARCHAR AS subject, '' AS detail FROM has WHERE blob AND id IN (SELECT id FROM mine)
UNION ALL SELECT 'text-of-metadata-only', id::VARCHAR, '' FROM has WHERE body AND id IN (SELECT id FROM mine)""")
def _(s, d):
    return package_checks.metadata_only_stripped(*_package(s, d))


@query("full_content_intact", f"""{LISTED}, {DUMPED}, {TEXTS}, {_HAS}, mine AS (SELECT DISTINCT id FROM listed WHERE distribution IN ('full-text', 'internal'))
SELECT 'blob-missing' AS "check", m.id::VARCHAR AS subject, '' AS detail FROM mine m LEFT JOIN has h USING (id) WHERE NOT coalesce(blob, false)
UNION ALL SELECT 'text-missing', m.id::VARCHAR, '' FROM mine m LEFT JOIN has h USING (id) WHERE NOT coalesce(body, false)""")
def _(s, d):
    return package_checks.full_content_intact(*_package(s, d))


@query("pages_embedded", f"""WITH {PAGES}, t AS (SELECT count(*) AS n, count(*) FILTER (WHERE embedding IS NULL) AS bare FROM pg)
SELECT 'page-count' AS "check", 'pages' AS subject, n::VARCHAR AS detail FROM t WHERE n <> 7 UNION ALL SELECT 'not-embedded', 'pages', bare::VARCHAR FROM t WHERE bare > 0""")
def _(s, d):
    return package_checks.pages_embedded(_pages(s, d), 7)


_TABLES = ("region", "nation", "part", "labels")


def _columns(s, d):
    return files.catalog_columns({t: table(s, d, t) for t in _TABLES})


_CATALOG = "cat AS (SELECT table_name AS t, column_name AS c FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'part', 'labels'))"


@query("columns_classified", f"""WITH {_CATALOG} SELECT DISTINCT 'unknown-table' AS "check", t AS subject, '' AS detail FROM cat WHERE t = 'labels'
UNION ALL SELECT 'unknown-column', t || '.' || c, '' FROM cat WHERE t <> 'labels' AND (c LIKE '%name' OR c LIKE '%price')""")
def _(s, d):
    classes = _columns(s, d).filter("table <> 'labels' AND NOT (column LIKE '%name' OR column LIKE '%price')")
    return package_checks.columns_classified(_columns(s, d), classes)


@query("no_generated_columns", f"WITH {_CATALOG} SELECT 'generated-column' AS \"check\", t || '.' || c AS subject, '' AS detail FROM cat WHERE c IN ('p_size', 'r_name')")
def _(s, d):
    generated = s.createDataFrame([("part", "p_size"), ("region", "r_name"), ("region", "tsv")], "table string, column string")
    return package_checks.no_generated_columns(_columns(s, d), generated)


@query("counts_match_mode", """SELECT 'row-count' AS "check", 'orders' AS subject, (SELECT count(*) FROM orders)::VARCHAR AS detail UNION ALL SELECT 'row-count', 'gone', NULL""")
def _(s, d):
    counts = {t: table(s, d, t).count() for t in ("orders", "nation")}
    found = s.createDataFrame(list(counts.items()), "table string, rows long")
    return package_checks.counts_match_mode(True, {"orders": counts["orders"] + 1, "nation": counts["nation"], "gone": 1}, found)


@query("bundled_files", """WITH f AS (SELECT page_id, url AS path, md5(url) AS sha FROM (SELECT min(page_id) AS page_id, url FROM pages GROUP BY url))
SELECT CASE WHEN page_id % 5 = 0 THEN 'missing-file' WHEN page_id % 5 = 1 THEN 'changed-file' ELSE 'extra-file' END AS "check", path AS subject, '' AS detail FROM f WHERE page_id % 5 < 3""")
def _(s, d):
    rows = table(s, d, "pages").groupBy(F.col("url").alias("path")).agg(F.min("page_id").alias("n")).withColumn("sha256", F.md5("path"))
    declared = rows.filter("n % 5 <> 2").select("path", "sha256")
    present = rows.filter("n % 5 <> 0").select("path", F.when(F.col("n") % 5 == 1, "other").otherwise(F.col("sha256")).alias("sha256"))
    return package_checks.bundled_files(declared, present)


@query("newest_package", """SELECT max(n) AS name FROM (SELECT concat('kb-', CASE WHEN o_orderkey % 3 = 0 THEN 'full' WHEN o_orderkey % 3 = 1 THEN 'public' ELSE 'full-override' END, '-', strftime(o_orderdate, '%Y%m%d'), '.tar.zst') AS n FROM orders)
WHERE regexp_full_match(n, 'kb-full-[0-9]{8}\\.tar\\.zst')""")
def _(s, d):
    kind = F.when(F.col("o_orderkey") % 3 == 0, "full").when(F.col("o_orderkey") % 3 == 1, "public").otherwise("full-override")
    names = table(s, d, "orders").select(F.concat(F.lit("kb-"), kind, F.lit("-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".tar.zst")).alias("name"))
    return package_checks.newest_package(names, "full")


@query("models_agree", """SELECT 'model-digest' AS "check", CASE WHEN c_custkey % 2 = 0 THEN c_name || ':latest' ELSE c_name || ':v1' END AS subject,
  CASE WHEN c_custkey % 5 = 0 THEN 'not served' ELSE 'bad' END AS detail FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0""")
def _(s, d):
    rows = table(s, d, "customer")
    name = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit(":v1")))
    full = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(":latest"))).otherwise(F.concat("c_name", F.lit(":v1")))
    served = rows.filter("c_custkey % 5 <> 0").select(full.alias("model"), F.when(F.col("c_custkey") % 7 == 0, "bad").otherwise("good").alias("digest"))
    return package_checks.models_agree(rows.select(name.alias("model"), F.lit("good").alias("digest")), served)


# --- loads, runs, merges ----------------------------------------------------------------
def _blob_documents(s, d):
    digest = F.when(F.col("doc_id") % 3 == 0, F.sha2("text", 256)).otherwise("old")
    docs = table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("source_path"), digest.alias("source_sha256"), F.lit(None).cast("binary").alias("source_blob"))
    return docs, table(s, d, "documents").filter("doc_id % 5 <> 0").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))


@query("blob_load", "SELECT doc_id AS id, CASE WHEN doc_id % 5 <> 0 OR doc_id % 3 = 0 THEN sha256(text) ELSE 'old' END AS source_sha256, doc_id % 5 <> 0 AND doc_id % 3 <> 0 AS loaded FROM documents")
def _(s, d):
    return runs.load_blobs(*_blob_documents(s, d))[0].select("id", "source_sha256", F.col("source_blob").isNotNull().alias("loaded"))


@query("blob_load_states", "SELECT CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 3 = 0 THEN 'unchanged' ELSE 'loaded' END AS state, count(*) AS n FROM documents GROUP BY 1")
def _(s, d):
    return runs.load_blobs(*_blob_documents(s, d))[1]


@query("blobs_intact", "SELECT 'blob-digest' AS \"check\", doc_id::VARCHAR AS subject, '' AS detail FROM documents WHERE doc_id % 4 = 1")
def _(s, d):
    docs = table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("source_blob"), F.when(F.col("doc_id") % 4 == 1, "no").otherwise(F.sha2("text", 256)).alias("source_sha256"))
    return package_checks.blobs_intact(docs)


def _runs(s, d):
    return table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("spike"), F.col("s_acctbal").alias("tau"))


def _thresholds(s, d):
    return table(s, d, "lineitem").select(F.col("l_suppkey").alias("run_id"), F.col("l_orderkey").alias("candidate_key"), F.col("l_quantity").alias("score"))


def _new_run(s, d):
    return _runs(s, d).filter("id = 3").select("spike", F.lit(0.5).alias("tau"))


@query("run_establish", "SELECT s_suppkey AS id, s_name AS spike, s_acctbal AS tau FROM supplier WHERE s_suppkey <> 3 UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier), s_name, 0.5 FROM supplier WHERE s_suppkey = 3")
def _(s, d):
    return runs.establish_run(_runs(s, d), {}, _new_run(s, d))[0]


@query("run_cascade", "SELECT l_suppkey AS run_id, count(*) AS n FROM lineitem WHERE l_suppkey <> 3 GROUP BY 1")
def _(s, d):
    _table, children = runs.establish_run(_runs(s, d), {"t": _thresholds(s, d)}, _new_run(s, d))
    return children["t"].groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


@query("run_amend", "SELECT s_suppkey AS id, s_name AS spike, CASE WHEN s_name = 'Supplier#000000003' THEN 0.25 ELSE s_acctbal END AS tau FROM supplier")
def _(s, d):
    return runs.amend_run(_runs(s, d), "Supplier#000000003", {"tau": F.lit(0.25)})


@query("threshold_append", "SELECT run_id, count(*) AS n, sum(score) AS total FROM (SELECT l_suppkey AS run_id, l_quantity AS score FROM lineitem UNION ALL SELECT 999999, p_size::DOUBLE FROM part) GROUP BY 1")
def _(s, d):
    more = table(s, d, "part").select(F.col("p_partkey").alias("candidate_key"), F.col("p_size").cast("double").alias("score"))
    rows, _n = runs.append_rows(_thresholds(s, d), 999999, more)
    return rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))


@query("replace_by_key", "SELECT s_suppkey AS id, s_name AS spike, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_acctbal END AS tau FROM supplier")
def _(s, d):
    return merge.replace_by(_runs(s, d), _runs(s, d).filter("id % 2 = 0").drop("tau"), "id")


@query("fill_column", "SELECT s_suppkey AS id, s_name AS spike, CASE WHEN s_suppkey % 3 = 0 THEN -1.0 ELSE s_acctbal END AS tau FROM supplier")
def _(s, d):
    return merge.fill_column(_runs(s, d), _runs(s, d).filter("id % 3 = 0").select("id", F.lit(-1.0).alias("tau")), "id", "tau")


@query("upsert_rows", "SELECT s_suppkey AS id, s_name AS spike, CASE WHEN s_suppkey % 3 = 0 THEN -1.0 ELSE s_acctbal END AS tau FROM supplier")
def _(s, d):
    return merge.upsert_rows(_runs(s, d), _runs(s, d).filter("id % 3 = 0").withColumn("tau", F.lit(-1.0)), ["id"])


@query("nearest_to_tau", f"{with_sql('journal')} SELECT id, round(abs(score - 50), 6) AS gap FROM journal WHERE score IS NOT NULL ORDER BY abs(score - 50), id LIMIT 10")
def _(s, d):
    found = stats.nearest_to(load(s, d, "journal").select("id", "score"), 50.0, key="id")
    return found.select("id", F.round("gap", 6).alias("gap"))


# --- texts and files --------------------------------------------------------------------
@query("page_texts", "SELECT doc_id, left(translate(coalesce(text, ''), chr(10) || chr(13), '  '), 6000) AS t FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", tx.page_text(F.col("text")).alias("t"))


@query("safe_ids", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS id, CASE WHEN contains(url, 'example') THEN nullif(regexp_replace(rtrim(url, '/'), '^.*/', ''), '') END AS short FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", tx.safe_id(F.col("url")).alias("id"), tx.mathnet_id(F.col("url"), "example").alias("short"))


@query("years_in", r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(concat('In 1987, ', 1900 + doc_id % 150, ' and 1987 of ', doc_id), '\b(1[89]\d\d|20\d\d)\b', 1))), ' ') AS years FROM documents")
def _(s, d):
    text = F.concat(F.lit("In 1987, "), (1900 + F.col("doc_id") % 150).cast("string"), F.lit(" and 1987 of "), F.col("doc_id").cast("string"))
    return table(s, d, "documents").select("doc_id", F.array_join(F.transform(text_sources.years_in(text), lambda y: y.cast("string")), " ").alias("years"))


@query("contributions", """WITH x AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations)
SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY CASE role WHEN 'assistant' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, i) FILTER (WHERE trim(coalesce(text, '')) <> '') AS t FROM x GROUP BY conv_id""")
def _(s, d):
    kind = F.when(F.col("role") == "assistant", "summary").when(F.col("role") == "user", "review").otherwise("other")
    items = table(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", kind.alias("kind")))).alias("x"))
    items = items.select("conv_id", F.transform("x", lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text"))).alias("x"))
    return items.select("conv_id", F.nullif(text_sources.contributions(F.col("x")), F.lit("")).alias("t"))


@query("cache_hits", "SELECT max_by(text, turn) AS body, conv_id AS name FROM conversations WHERE strlen(text) > 40 AND conv_id % 2 = 0 GROUP BY conv_id")
def _(s, d):
    turns = table(s, d, "conversations")
    entries = turns.select(F.col("conv_id").alias("name"), F.col("text").alias("body"), F.col("turn").alias("at"))
    return files.cached(entries, turns.filter("conv_id % 2 = 0").select(F.col("conv_id").alias("name")), 40)[0]


@query("cache_misses", "SELECT DISTINCT conv_id AS name FROM conversations c WHERE conv_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM conversations e WHERE e.conv_id = c.conv_id AND strlen(e.text) > 40)")
def _(s, d):
    turns = table(s, d, "conversations")
    entries = turns.select(F.col("conv_id").alias("name"), F.col("text").alias("body"), F.col("turn").alias("at"))
    return files.cached(entries, turns.filter("conv_id % 2 = 0").select(F.col("conv_id").alias("name")), 40)[1]


@query("ocr_pages", f"WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), k AS (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM p) SELECT doc_id AS path, unnest(range(1, len(l) + 1))::INT AS page_number, unnest(l) AS body FROM k")
def _(s, d):
    texts = table(s, d, "documents").filter("text IS NOT NULL").select(F.col("doc_id").alias("path"), F.translate("text", "\n", "\f").alias("text"))
    pages = F.size(F.split("text", "\f")) - F.endswith(F.col("text"), F.lit("\f")).cast("int")
    empty = F.when(F.col("text") == "", 0).otherwise(pages)
    return files.ocr_pages(texts, texts.select("path", empty.alias("pages")))


DDL = """SELECT event_id AS ordinal, CASE event_id % 6 WHEN 0 THEN concat('CREATE SCHEMA s', event_id % 4, ';') WHEN 1 THEN concat('COPY s', event_id % 4, '.t (a) FROM stdin;')
  WHEN 2 THEN concat('ALTER SEQUENCE s.q', event_id, ' OWNED BY s.t', event_id % 9, '.id;') WHEN 3 THEN concat('SELECT setval(pg_get_serial_sequence(''s.t', event_id % 9, ''', ''id''), 4);')
  WHEN 4 THEN concat('SELECT pg_catalog.setval(''s.q', event_id - 2, ''', 9, true);') ELSE 'SET x = 1;' END AS line FROM events"""


@query("dump_statements", """SELECT event_id AS ordinal, CASE WHEN event_id % 6 < 2 THEN 'schema' WHEN event_id % 6 = 2 THEN 'sequence-owned' ELSE 'sequence-set' END AS kind,
  CASE WHEN event_id % 6 < 2 THEN 's' || (event_id % 4) ELSE 's' END AS schema,
  CASE event_id % 6 WHEN 2 THEN 't' || (event_id % 9) WHEN 3 THEN 't' || (event_id % 9) WHEN 4 THEN 't' || ((event_id - 2) % 9) END AS "table", CASE WHEN event_id % 6 >= 2 THEN 'id' END AS "column"
FROM events WHERE event_id % 6 < 5 AND (event_id % 6 <> 4 OR event_id >= 2)""")
def _(s, d):
    return files.statements(s.sql(DDL.replace("FROM events", "FROM {events}"), events=table(s, d, "events")))


ON_DISK = """SELECT id, CASE WHEN id % 11 = 0 THEN 'exclude' WHEN id % 13 = 0 THEN 'unclassified' ELSE 'include' END AS kind, concat('f', id) AS path,
  CASE WHEN id % 10 > 0 THEN id % 4 END AS pages, concat('h', id % 6) AS sha256 FROM corpus WHERE id % 7 <> 0"""
INDEXED = """SELECT id, CASE WHEN id % 10 = 1 THEN 9 ELSE id % 4 END AS pages_count, concat('f', CASE WHEN id % 12 = 5 THEN -1 ELSE id END) AS source_path,
  concat('h', id % 5) AS source_sha256, CASE WHEN id % 9 <> 0 THEN 'u' END AS source_url, id % 8 <> 0 AS has_blob FROM corpus WHERE id % 17 <> 0"""


@query("completeness", f"""{with_sql('corpus')}, f AS ({ON_DISK}), d AS ({INDEXED}), i AS (SELECT * FROM f WHERE kind = 'include'),
x AS (SELECT d.*, i.id IS NOT NULL AS own, i.pages, h.path AS there, h.sha256 FROM d LEFT JOIN i USING (id) LEFT JOIN f h ON h.path = d.source_path)
SELECT path AS id, 'unclassified' AS problem FROM f WHERE kind = 'unclassified' UNION ALL SELECT id::VARCHAR, 'not-indexed' FROM i WHERE id NOT IN (SELECT id FROM d)
UNION ALL SELECT id::VARCHAR, 'phantom-row' FROM x WHERE NOT own UNION ALL SELECT id::VARCHAR, 'page-count' FROM x WHERE pages <> pages_count
UNION ALL SELECT id::VARCHAR, 'empty-metadata' FROM x WHERE own AND pages IS NULL AND pages_count < 1 UNION ALL SELECT id::VARCHAR, 'broken-path' FROM x WHERE own AND there IS NULL
UNION ALL SELECT id::VARCHAR, 'no-blob' FROM x WHERE own AND there IS NOT NULL AND NOT has_blob UNION ALL SELECT id::VARCHAR, 'hash-mismatch' FROM x WHERE own AND has_blob AND sha256 <> source_sha256
UNION ALL SELECT id::VARCHAR, 'no-url' FROM x WHERE own AND source_url IS NULL AND id % 2 = 0""")
def _(s, d):
    corpus = load(s, d, "corpus")
    on_disk, indexed = (s.sql(q.replace("FROM corpus", "FROM {corpus}"), corpus=corpus) for q in (ON_DISK, INDEXED))
    return checks.completeness(on_disk, indexed, corpus.filter("id % 2 = 0").select("id"))


@query("set_agreement", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only-left' ELSE 'only-right' END AS side FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_suppkey % 2 = 0) a FULL JOIN (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 3 = 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def _(s, d):
    left = table(s, d, "lineitem").filter("l_suppkey % 2 = 0").select(F.col("l_suppkey").alias("k"))
    return checks.set_agreement(left, table(s, d, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("k")), "k")


@query("full_dump", """WITH r AS (SELECT 1 AS position, r_regionkey || chr(9) || r_name AS line FROM region), n AS (SELECT 2, n_nationkey || chr(9) || n_name || chr(9) || n_regionkey FROM nation)
SELECT position, line FROM r UNION ALL SELECT * FROM n
UNION ALL SELECT * FROM (VALUES (0, 'CREATE SCHEMA geo;'), (0, 'CREATE TABLE geo.region (r_regionkey integer, r_name text);'),
  (0, 'CREATE TABLE geo.nation (n_nationkey integer, n_name text, n_regionkey integer);'), (1, 'COPY geo.region (r_regionkey, r_name) FROM stdin;'), (1, '\\.'),
  (2, 'COPY geo.nation (n_nationkey, n_name, n_regionkey) FROM stdin;'), (2, '\\.'))
UNION ALL SELECT 3, 'SELECT setval(pg_get_serial_sequence(''geo.nation'', ''n_nationkey''), ' || (SELECT max(n_nationkey) FROM nation) || ');'""")
def _(s, d):
    frames = {"nation": table(s, d, "nation"), "region": table(s, d, "region")}
    return copy_dump.full_dump(frames, "geo", [("nation", "region")], {"nation": "n_nationkey"}, {"nation", "region"}).select("position", "line")


@query("seed_matches", f"{with_sql('corpus')} SELECT id, min('r' || vec_id) AS record FROM corpus JOIN embeddings ON vec_id = id WHERE source_dir = 'theory/iis' AND extraction_state <> 'metadata' GROUP BY id")
def _(s, d):
    matches = table(s, d, "embeddings").select(F.col("vec_id").alias("document_id"), F.concat(F.lit("r"), F.col("vec_id").cast("string")).alias("record"))
    return seeding.seed_matches(seeding.corpus_seeds(load(s, d, "corpus")), matches)[0]


def _answers(s, d):
    docs = table(s, d, "documents").select(F.col("doc_id").alias("document_id"), F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("value"))
    error = F.when(F.col("document_id") % 7 == 0, "timeout")
    fetched = docs.filter("document_id % 2 = 1").select("document_id", F.when(error.isNull() & (F.col("document_id") % 11 != 0), F.concat("value", F.lit("f"))).alias("value"), error.alias("error"))
    stored = docs.filter("document_id % 3 = 0")
    cached = docs.filter("document_id % 5 = 0").withColumn("value", F.concat("value", F.lit("c")))
    return seeding.with_precedence(docs, stored, cached, fetched)


@query("answer_precedence", """SELECT doc_id AS document_id, CASE WHEN doc_id % 3 = 0 THEN 'v' || doc_id WHEN doc_id % 5 = 0 THEN 'v' || doc_id || 'c' ELSE 'v' || doc_id || 'f' END AS value,
  CASE WHEN doc_id % 3 = 0 THEN 'stored' WHEN doc_id % 5 = 0 THEN 'cached' ELSE 'fetched' END AS origin FROM documents
WHERE doc_id % 3 = 0 OR doc_id % 5 = 0 OR (doc_id % 2 = 1 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0)""")
def _(s, d):
    return _answers(s, d)[0]


@query("answer_failures", "SELECT doc_id AS document_id, 'timeout' AS error FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 2 = 1 AND doc_id % 7 = 0")
def _(s, d):
    return _answers(s, d)[1]


@query("known_vectors", "SELECT 'W' || vec_id AS key FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)")
def _(s, d):
    keys = table(s, d, "documents").select(F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("key"))
    return seeding.known_vectors(load(s, d, "works"), keys).select("key")


def _described(s, d):
    return load(s, d, "works").withColumns({
        "abstract": F.when(F.col("id") % 3 != 0, F.col("title")), "evidence": F.create_map(F.lit("abstract_source"), F.when(F.col("id") % 2 == 0, "zbmath").otherwise("openalex")),
        "titles": F.when(F.col("id") % 5 != 0, F.array("title")).otherwise(F.array().cast("array<string>")), "years": F.when(F.col("id") % 4 != 0, F.array("year")),
    })


@query("stored_abstracts", f"{with_sql('works')} SELECT document_id, title AS value FROM works WHERE document_id IS NOT NULL AND id % 3 <> 0 AND id % 2 = 0")
def _(s, d):
    return seeding.stored_abstracts(_described(s, d))


@query("stored_titles", f"{with_sql('works')} SELECT document_id, title, CASE WHEN id % 4 <> 0 THEN 1 ELSE 0 END AS n_years FROM works WHERE document_id IS NOT NULL AND id % 5 <> 0")
def _(s, d):
    return seeding.stored_titles(_described(s, d)).select("document_id", F.col("titles")[0].alias("title"), F.size("years").alias("n_years"))


@query("vectors_first", "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE strlen(p_name) END::DOUBLE AS first FROM part")
def _(s, d):
    part = table(s, d, "part")
    stored = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.array(F.col("p_size").cast("float")).alias("embedding"))
    made = seeding.vectors_of(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text")), stored, lambda texts: [[float(len(t.encode()))] for t in texts], 1)
    return made.select("id", F.col("embedding")[0].cast("double").alias("first"))

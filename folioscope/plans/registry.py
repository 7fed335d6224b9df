"""Registered queries over the stand-in tables, with the SQL they are held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions import vectors as vec
from folioscope.functions.stemmer import russian_tokens
from folioscope.operators import checks, crawl, graph, merge, publish, retrieval, stats
from folioscope.plans.standins import load, table, with_sql
from folioscope.sources import copy_dump, snapshots, text_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- shared pieces of the oracle's SQL -------------------------------------------------
COS = "coalesce(list_inner_product({a}, {b}) / nullif(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})), 0), 0)"
DOUBLES = "w AS (SELECT * REPLACE ([x::DOUBLE for x in embedding] AS embedding) FROM works)"
CENTROID = "mean AS (SELECT i, avg(x) AS m FROM (SELECT unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM w WHERE kind = 'our-document' AND embedding IS NOT NULL) GROUP BY i),\ntarget AS (SELECT list(m ORDER BY i) AS v FROM mean)"
FIRST = "target AS (SELECT embedding AS v FROM w WHERE id = 0)"
SCORED = f"scored AS (SELECT w.*, round({COS.format(a='w.embedding', b='t.v')}, 5) AS score FROM w, target t WHERE embedding IS NOT NULL)"
LINKS = """links AS (
  SELECT n.id, count(DISTINCT e.other) AS n FROM near n
  JOIN (SELECT citing AS node, cited AS other FROM cites UNION ALL SELECT cited, citing FROM cites) e ON e.node = n.id
  JOIN works o ON o.id = e.other AND o.kind = 'our-document' GROUP BY n.id)"""


def _candidates_sql(target: str, more: str = "") -> str:
    return f"""{with_sql('works', 'cites')}, {DOUBLES}, {target}, {SCORED},
near AS (SELECT * FROM scored WHERE kind = 'external-skeleton' ORDER BY score DESC, id LIMIT 20), {LINKS}
SELECT n.key, n.year, n.title, n.score, coalesce(l.n, 0)::BIGINT AS links FROM near n LEFT JOIN links l USING (id) {more}"""


def _target(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector of work 0 stands for an embedded question."""
    return [float(x) for x in table(spark, sf_dir, "embeddings").filter("vec_id = 0").first()["embedding"]]


# --- graph -----------------------------------------------------------------------------
@query("candidates", _candidates_sql(CENTROID))
def _(s, d):
    return graph.candidates(load(s, d, "works"), load(s, d, "cites"))


@query("candidates_query", _candidates_sql(FIRST))
def _(s, d):
    return graph.candidates(load(s, d, "works"), load(s, d, "cites"), target=_target(s, d))


@query("candidates_min_links", _candidates_sql(CENTROID, "WHERE coalesce(l.n, 0) >= 1"))
def _(s, d):
    return graph.candidates(load(s, d, "works"), load(s, d, "cites"), min_links=1)


for _depth in (1, 2, 3):
    QUERIES[f"citers_d{_depth}"] = lambda s, d, k=_depth: graph.citers(load(s, d, "works"), load(s, d, "cites"), 116, k)
    ORACLE_SQL[f"citers_d{_depth}"] = f"""{with_sql('works', 'cites').replace('WITH ', 'WITH RECURSIVE ', 1)},
walk(node, n) AS (SELECT id, 0 FROM works WHERE document_id = 116 UNION SELECT c.citing, w.n + 1 FROM walk w JOIN cites c ON c.cited = w.node WHERE w.n < {_depth})
SELECT key, title, year, kind FROM works WHERE id IN (SELECT node FROM walk WHERE n > 0)"""


def _cocitation_sql(cap: int, limit: int = 500) -> str:
    return f"""{with_sql('baskets', 'parts')},
thin AS (SELECT citing FROM baskets GROUP BY citing HAVING count(*) <= {cap}),
pairs AS (SELECT a.cited AS a_id, b.cited AS b_id, count(DISTINCT a.citing) AS n FROM baskets a JOIN thin USING (citing) JOIN baskets b ON b.citing = a.citing AND a.cited < b.cited GROUP BY 1, 2 HAVING count(DISTINCT a.citing) >= 2)
SELECT x.key AS a_key, coalesce(x.title, '') AS a_title, y.key AS b_key, coalesce(y.title, '') AS b_title, n AS "count" FROM pairs JOIN parts x ON x.id = a_id JOIN parts y ON y.id = b_id ORDER BY n DESC, x.key, y.key LIMIT {limit}"""


@query("cocitation", _cocitation_sql(200))
def _(s, d):
    return graph.cocitation(load(s, d, "parts"), load(s, d, "baskets"))


@query("cocitation_capped", _cocitation_sql(6))
def _(s, d):
    return graph.cocitation(load(s, d, "parts"), load(s, d, "baskets"), max_out_degree=6)


@query("hybrid_graph", f"""{with_sql('works', 'cites')}, {DOUBLES}, {FIRST}, {SCORED},
near AS (SELECT * FROM scored ORDER BY score DESC, id LIMIT 10)
SELECT n.key, n.year, n.title, n.score, 'cites' AS direction, o.key AS neighbor_key, o.title AS neighbor_title FROM near n JOIN cites c ON c.citing = n.id JOIN works o ON o.id = c.cited
UNION ALL SELECT n.key, n.year, n.title, n.score, 'cited_by', o.key, o.title FROM near n JOIN cites c ON c.cited = n.id JOIN works o ON o.id = c.citing""")
def _(s, d):
    return graph.hybrid(load(s, d, "works"), load(s, d, "cites"), _target(s, d))


@query("kind_census", f"{with_sql('works')} SELECT kind, count(*) AS n FROM works GROUP BY kind")
def _(s, d):
    return graph.kind_census(load(s, d, "works"))


@query("projection_digest", f"""{with_sql('works', 'cites')}, named AS (SELECT a.key AS a, b.key AS b, c.source FROM cites c JOIN works a ON a.id = c.citing JOIN works b ON b.id = c.cited)
SELECT (SELECT count(*) FROM works) AS works, (SELECT count(*) FROM named) AS edges,
  (SELECT md5(coalesce(string_agg(key || '|' || kind || '|' || coalesce(year::VARCHAR, '') || '|' || coalesce(title, ''), chr(10) ORDER BY key), '')) FROM works) AS works_md5,
  (SELECT md5(coalesce(string_agg(a || '|' || b || '|' || source, chr(10) ORDER BY a, b, source), '')) FROM named) AS edges_md5""")
def _(s, d):
    return graph.projection_digest(load(s, d, "works"), load(s, d, "cites"))


@query("edge_union_both_dirs", f"{with_sql('cites')} SELECT node, count(DISTINCT other) AS n FROM (SELECT citing AS node, cited AS other FROM cites UNION ALL SELECT cited, citing FROM cites) GROUP BY node")
def _(s, d):
    return graph.both_directions(load(s, d, "cites")).distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n"))


@query("projected_vertices", f"""{with_sql('works')} SELECT id, key, kind, year, title,
  '{{"key":"' || key || '","kind":"' || kind || '"' || coalesce(',"year":' || year, '') || ',"title":"' || title || '"}}' AS properties FROM works""")
def _(s, d):
    return graph.project(load(s, d, "works"), load(s, d, "cites"))[0]


@query("projected_edges", f"{with_sql('cites')} SELECT citing AS start_id, cited AS end_id, source FROM cites")
def _(s, d):
    return graph.project(load(s, d, "works"), load(s, d, "cites"))[1].drop("id")


# --- vectors and retrieval -------------------------------------------------------------
PAGES = """pages0 AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS page_number, unnest(string_split(text, chr(10))) AS body FROM documents),
pg AS (SELECT p.doc_id * 100000 + p.page_number AS id, p.doc_id AS document_id, p.page_number, p.body, CASE WHEN p.page_number = 1 THEN [x::DOUBLE for x in e.embedding] END AS embedding
  FROM pages0 p LEFT JOIN embeddings e ON e.vec_id = p.doc_id)"""
NEAR_PAGES = f"near AS (SELECT id, document_id, page_number, round(1 - {COS.format(a='p.embedding', b='t.v')}, 5) AS distance FROM pg p, target t WHERE p.embedding IS NOT NULL)"
FIRST_PAGE = "target AS (SELECT [x::DOUBLE for x in embedding] AS v FROM embeddings WHERE vec_id = 0)"
TOKENS = "[t for t in string_split_regex(lower(coalesce(body, '')), '[^\\p{L}\\p{N}]+') if t <> '']"


def _pages(s, d) -> DataFrame:
    """Lines are pages; a document's vector is its first page's."""
    lines = table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "body"))
    pages = lines.select((F.col("doc_id") * 100000 + F.col("p") + 1).alias("id"), F.col("doc_id").alias("document_id"), (F.col("p") + 1).alias("page_number"), "body")
    vectors = table(s, d, "embeddings").select(F.col("vec_id").alias("document_id"), F.lit(1).alias("page_number"), "embedding")
    return pages.join(vectors, ["document_id", "page_number"], "left")


@query("vector_topk", f"WITH {PAGES}, {FIRST_PAGE}, {NEAR_PAGES} SELECT n.document_id, n.page_number, n.distance, substr(p.body, 1, 200) AS snippet FROM (SELECT * FROM near ORDER BY distance, document_id, page_number LIMIT 20) n JOIN pg p USING (id)")
def _(s, d):
    return retrieval.vector(_pages(s, d), _target(s, d))


@query("vector_rank_of", f"WITH {PAGES}, {FIRST_PAGE}, {NEAR_PAGES}, ranked AS (SELECT *, row_number() OVER (ORDER BY distance, document_id, page_number) AS rank FROM near) SELECT document_id, page_number, distance, rank FROM ranked WHERE document_id = 7 AND page_number = 1")
def _(s, d):
    return retrieval.rank_of(_pages(s, d), _target(s, d), 7, 1)


@query("runner_up", f"WITH {PAGES}, {FIRST_PAGE}, {NEAR_PAGES}, ranked AS (SELECT *, row_number() OVER (ORDER BY distance, document_id, page_number) AS rank FROM near) SELECT rank::INT AS rank, document_id, page_number, distance FROM ranked WHERE rank <= 2")
def _(s, d):
    return retrieval.runner_up(_pages(s, d), _target(s, d))


def _by_position(s, vector: list[float]) -> DataFrame:
    return s.createDataFrame([(i + 1, round(x, 5)) for i, x in enumerate(vector)], "i int, m double")


@query("centroid_avg", f"{with_sql('works')}, {DOUBLES}, {CENTROID} SELECT i::INT AS i, round(m, 5) AS m FROM mean")
def _(s, d):
    return _by_position(s, graph.centroid_avg(load(s, d, "works").filter("kind = 'our-document'")))


@query("centroid_unit", f"""{with_sql('works')}, {DOUBLES}, u AS (SELECT [x / sqrt(list_inner_product(embedding, embedding)) for x in embedding] AS v FROM w WHERE kind = 'our-document'),
mean AS (SELECT i, avg(x) AS m FROM (SELECT unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM u) GROUP BY i)
SELECT i::INT AS i, round(m / (SELECT sqrt(sum(m * m)) FROM mean), 5) AS m FROM mean""")
def _(s, d):
    return _by_position(s, graph.centroid_unit(load(s, d, "works").filter("kind = 'our-document'")))


@query("dims_census", "SELECT len(embedding)::INT AS dims, count(*) AS n FROM embeddings GROUP BY 1")
def _(s, d):
    return table(s, d, "embeddings").groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))


@query("cosine_to_first", f"{with_sql('works')}, {DOUBLES}, {FIRST}, {SCORED} SELECT id, score FROM scored")
def _(s, d):
    return load(s, d, "works").select("id", F.round(vec.cosine(F.col("embedding"), vec.literal(_target(s, d))), 5).alias("score"))


PHRASE = "the the"
_PHRASE_SQL = f"""WITH {PAGES}, tok AS (SELECT id, document_id, page_number, body, {TOKENS} AS t FROM pg),
hits AS (SELECT id, document_id, page_number, body, len([i for i in range(1, len(t)) if t[i] = 'the' and t[i + 1] = 'the']) AS hits FROM tok)"""


@query("phrase_search", _PHRASE_SQL + " SELECT document_id, page_number, substr(body, 1, 200) AS snippet FROM hits WHERE hits > 0 ORDER BY document_id, page_number LIMIT 20")
def _(s, d):
    return retrieval.fulltext(_pages(s, d), PHRASE, analyzer=tx.simple_tokens)


@query("phrase_hits", _PHRASE_SQL + " SELECT count(*) AS pages, sum(hits)::BIGINT AS hits FROM hits WHERE hits > 0")
def _(s, d):
    return retrieval.hit_count(_pages(s, d), PHRASE, analyzer=tx.simple_tokens)


@query("phrase_hits_public", _PHRASE_SQL.replace("WITH ", with_sql("corpus") + ", ", 1) + """ SELECT count(*) AS pages, coalesce(sum(hits), 0)::BIGINT AS hits FROM hits
WHERE hits > 0 AND document_id IN (SELECT id FROM corpus WHERE public_distribution IN ('full-text', 'internal'))""")
def _(s, d):
    return retrieval.hit_count(_pages(s, d), PHRASE, load(s, d, "corpus"), tx.simple_tokens)


@query("rrf_search", _PHRASE_SQL + f""", {FIRST_PAGE}, {NEAR_PAGES},
ft AS (SELECT id, row_number() OVER (ORDER BY hits DESC, id) AS r FROM hits WHERE hits > 0 QUALIFY r <= 100),
vc AS (SELECT id, row_number() OVER (ORDER BY distance, id) AS r FROM near QUALIFY r <= 100),
best AS (SELECT coalesce(ft.id, vc.id) AS id, round(coalesce(1.0::DOUBLE / (60 + ft.r), 0) + coalesce(1.0::DOUBLE / (60 + vc.r), 0), 9) AS score FROM ft FULL JOIN vc ON ft.id = vc.id ORDER BY score DESC, 1 LIMIT 20)
SELECT p.document_id, p.page_number, b.score, substr(p.body, 1, 200) AS snippet FROM best b JOIN pg p USING (id)""")
def _(s, d):
    return retrieval.rrf(_pages(s, d), PHRASE, _target(s, d), analyzer=tx.simple_tokens)


_LEXEMES = "list_sort(list_distinct([t for t in string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+') if t <> '']))"


@query("lexeme_overlap", f"""WITH p AS (
  SELECT item_id AS query_id, doc_id AS id, {_LEXEMES.format('b.text')} AS q, {_LEXEMES.format('d.text')} AS l
  FROM benchmark b JOIN documents d ON d.doc_id % (SELECT max(item_id) + 1 FROM benchmark) = b.item_id)
SELECT query_id, id, array_to_string(list_sort(list_intersect(q, l)), ' ') AS lexemes, len(list_intersect(q, l))::BIGINT AS overlap FROM p""")
def _(s, d):
    bench, docs = table(s, d, "benchmark"), table(s, d, "documents")
    n = bench.agg((F.max("item_id") + 1).alias("n"))
    pairs = docs.crossJoin(F.broadcast(n)).select((F.col("doc_id") % F.col("n")).alias("query_id"), F.col("doc_id").alias("id"))
    pages, queries = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body")), bench.select(F.col("item_id").alias("query_id"), "text")
    found = retrieval.lexeme_overlap(pages, queries, pairs)
    return found.select("query_id", "id", F.array_join("lexemes", " ").alias("lexemes"), F.size("lexemes").cast("long").alias("overlap"))


@query("russian_search", _PHRASE_SQL + " SELECT document_id, page_number, substr(body, 1, 200) AS snippet FROM hits WHERE hits > 0 ORDER BY document_id, page_number LIMIT 20")  # Latin words have no Russian stem
def _(s, d):
    return retrieval.fulltext(_pages(s, d).drop("embedding"), PHRASE, 20, russian_tokens)


# --- statistics ------------------------------------------------------------------------
def _scores(s, d) -> DataFrame:
    return load(s, d, "journal").select("id", F.col("score"), "relation", F.col("candidate_key"))


@query("quantiles", f"{with_sql('journal')}, v AS (SELECT list(score ORDER BY score) AS l FROM journal) SELECT p AS point, l[round_even(p * (len(l) - 1), 0)::BIGINT + 1] AS value FROM v, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS p)")
def _(s, d):
    return stats.quantiles(_scores(s, d))


@query("histogram", f"""{with_sql('journal')}, e AS (SELECT min(score) AS lo, max(score) AS hi, (max(score) - min(score)) / 20 AS w FROM journal),
b AS (SELECT least(19, floor((score - lo) / w)::INT) AS bin, count(*) AS n FROM journal, e GROUP BY 1)
SELECT g.bin::INT AS bin, round(lo + g.bin * w, 5) AS low, round(lo + (g.bin + 1) * w, 5) AS high, coalesce(n, 0) AS "count" FROM e, range(20) g(bin) LEFT JOIN b ON b.bin = g.bin""")
def _(s, d):
    return stats.histogram(_scores(s, d)).withColumns({c: F.round(c, 5) for c in ("low", "high")})


@query("gap_tau", f"""{with_sql('journal')}, v AS (SELECT score FROM journal WHERE score IS NOT NULL),
m AS (SELECT min(score) AS lo, (list(score ORDER BY score))[count(*) // 2 + 1] AS med FROM v),
g AS (SELECT unnest(range(0, trunc((med - lo) / 0.02::DOUBLE)::BIGINT)) AS bin FROM m),
f AS (SELECT DISTINCT trunc((score - lo) / 0.02::DOUBLE)::BIGINT AS bin FROM v, m WHERE score <= med)
SELECT (SELECT lo FROM m) + (max(bin) + 0.5::DOUBLE) * 0.02::DOUBLE AS tau FROM g WHERE bin NOT IN (SELECT bin FROM f)""")
def _(s, d):
    tau = stats.suggest_tau(_scores(s, d), width=0.02)
    return s.createDataFrame([(tau,)], "tau double")


_REFS = "refs AS (SELECT concat('W', l_orderkey % 503) AS candidate_key, l_partkey AS ref FROM lineitem)"
_COST_TAUS = (10.0, 25.0, 50.0, 75.0, 90.0)


@query("cost_table", f"""{with_sql('journal')}, {_REFS}, t AS (SELECT unnest({list(_COST_TAUS)}::DOUBLE[]) AS tau),
k AS (SELECT tau, (SELECT count(*) FROM journal WHERE score >= tau) AS kept, (SELECT count(DISTINCT ref) FROM journal j JOIN refs r USING (candidate_key) WHERE score >= tau) AS refs FROM t)
SELECT tau, kept, refs, (ceil(refs / 50.0) + 2 * ceil(kept / 50.0))::BIGINT AS requests FROM k""")
def _(s, d):
    refs = table(s, d, "lineitem").select(F.concat(F.lit("W"), F.col("l_orderkey") % 503).alias("candidate_key"), F.col("l_partkey").alias("ref")).distinct()
    return stats.cost_table(_scores(s, d), refs, _COST_TAUS)


@query("percentile_cont", f"{with_sql('journal')} SELECT min(score) AS low, round(quantile_cont(score, 0.05), 5) AS p05, round(quantile_cont(score, 0.5), 5) AS p50, round(quantile_cont(score, 0.95), 5) AS p95, max(score) AS high FROM journal")
def _(s, d):
    return stats.percentile_cont(_scores(s, d), "score", (0.05, 0.5, 0.95)).withColumns({c: F.round(c, 5) for c in ("p05", "p50", "p95")})


@query("quartiles", f"{with_sql('journal')}, v AS (SELECT relation, list(score ORDER BY score) AS l, avg(score) AS m FROM journal GROUP BY relation) SELECT relation, len(l)::BIGINT AS n, l[len(l) // 4 + 1] AS p25, l[len(l) // 2 + 1] AS median, l[3 * len(l) // 4 + 1] AS p75, round(m, 5) AS mean FROM v")
def _(s, d):
    return stats.quartiles(_scores(s, d), "relation").withColumn("mean", F.round("mean", 5))


def _hubs(s, d) -> DataFrame:
    return load(s, d, "journal").filter("node_key IS NOT NULL").select(F.concat("node_key", F.lit("/"), F.col("id").cast("string")).alias("work_key"), "relation", (F.col("id") % 1000).alias("cited_by_count"))


_HUBS = "hubs AS (SELECT concat(node_key, '/', id) AS work_key, relation, id % 1000 AS cited_by_count FROM journal WHERE node_key IS NOT NULL)"


@query("hub_stats", f"{with_sql('journal')}, {_HUBS} SELECT relation, count(*) AS nodes, count(*) FILTER (WHERE cited_by_count > 900) AS over_cap, sum(cited_by_count)::BIGINT AS citers, max(cited_by_count) AS largest FROM hubs GROUP BY relation")
def _(s, d):
    return stats.hub_stats(_hubs(s, d), 900)


@query("hub_worst", f"{with_sql('journal')}, {_HUBS} SELECT * FROM hubs ORDER BY cited_by_count DESC, work_key LIMIT 10")
def _(s, d):
    return stats.hub_worst(_hubs(s, d))


@query("first_keep_per_node", f"{with_sql('journal')} SELECT DISTINCT ON (node_key) node_key, id AS first_id, relation FROM journal WHERE action = 'keep' AND node_key IS NOT NULL ORDER BY node_key, id")
def _(s, d):
    return stats.first_per_node(load(s, d, "journal"), "keep")


@query("frontier_counters", f"{with_sql('works', 'cites')} SELECT w.key AS frontier_key, count(c.citing) AS n_found, count(*) FILTER (WHERE c.citing % 2 = 0) AS n_kept FROM works w LEFT JOIN cites c ON c.cited = w.id GROUP BY w.key")
def _(s, d):
    w = load(s, d, "works").select("id", F.col("key").alias("frontier_key"))
    hits = load(s, d, "cites").join(w, F.col("cited") == F.col("id")).select("frontier_key", F.col("citing").alias("candidate_key"), (F.col("citing") % 2 == 0).alias("kept"))
    return stats.frontier_counters(w.select("frontier_key"), hits)


@query("calibration_keep_drop", f"{with_sql('journal')} SELECT id, score >= 50 AS kept FROM journal")
def _(s, d):
    return _scores(s, d).select("id", stats.keeps(F.col("score"), 50.0).alias("kept"))


# --- text ------------------------------------------------------------------------------
@query("embed_text", "SELECT doc_id, left(trim(trim(translate(source, chr(10) || chr(13), '  '), ' ' || chr(9)) || ' ' || trim(translate(text, chr(10) || chr(13), '  '), ' ' || chr(9)), ' ' || chr(9)), 6000) AS t FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", tx.works_text(F.col("source"), F.col("text")).alias("t"))


@query("normalize_title", "SELECT p_partkey, regexp_replace(replace(lower(regexp_replace(replace(p_name, '$', ' '), '\\\\[a-zA-Z]+', ' ', 'g')), 'ё', 'е'), '[^0-9a-zа-я]', '', 'g') AS t FROM part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", tx.normalize_title(F.col("p_name")).alias("t"))


@query("doi_suffix", "SELECT page_id, list_last(string_split(rtrim(lower(trim(url)), '.,'), '/')) AS suffix, list_last(string_split(rtrim(url, '/'), '/')) AS short FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", tx.doi_suffix(F.col("url")).alias("suffix"), tx.short_id(F.col("url")).alias("short"))


@query("html_titles", r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<title[^>]*>((?s).*?)</title>', 1, 'i'), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS title FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", text_sources.html_title(F.col("html")).alias("title"))


@query("twin_match", """WITH n AS (SELECT doc_id, regexp_replace(replace(lower(regexp_replace(replace(text, '$', ' '), '\\[a-zA-Z]+', ' ', 'g')), 'ё', 'е'), '[^0-9a-zа-я]', '', 'g') AS t FROM documents),
idx AS (SELECT t, max(doc_id) AS seed FROM n WHERE doc_id % 2 = 0 AND t <> '' GROUP BY t HAVING count(DISTINCT doc_id) = 1)
SELECT n.doc_id AS key, i.seed AS document_id, i.seed AS twin_of, 'title+year' AS twin_rule FROM n JOIN idx i USING (t) WHERE n.doc_id % 2 = 1""")
def _(s, d):
    rows = table(s, d, "documents").select(F.col("doc_id").alias("key"), F.col("text").alias("title"), F.lit(None).cast("int").alias("year"), F.lit("").alias("doi"))
    seeds = rows.filter("key % 2 = 0").select("key", F.col("key").alias("document_id"), F.array("title").alias("titles"), F.lit(None).cast("string").alias("mathnet_id"))
    return merge.find_twins(rows.filter("key % 2 = 1"), seeds, s.createDataFrame([], "document_id long, years array<int>"))


@query("restore_abstract", "SELECT conv_id, turn, array_to_string(string_split(text, ' '), ' ') AS t FROM conversations")
def _(s, d):
    words = table(s, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("p", "w"))
    index = words.groupBy("conv_id", "turn", "w").agg(F.sort_array(F.collect_list("p")).alias("at")).groupBy("conv_id", "turn").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("index"))
    return index.select("conv_id", "turn", tx.restore_abstract(F.col("index")).alias("t"))


@query("letter_stats", r"SELECT doc_id, length(regexp_replace(text, '[^Ѐ-ӿ]', '', 'g'))::INT AS cyrillic, length(regexp_replace(text, '[^À-ÿ]', '', 'g'))::INT AS latin1_supplement, length(regexp_replace(text, '[^a-zA-Z]', '', 'g'))::INT AS ascii_letters, length(regexp_replace(text, '[^\p{L}]|[Ѐ-ӿÀ-ÿa-zA-Z]', '', 'g'))::INT AS other_letters FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", *(c.alias(n) for n, c in tx.letter_stats(F.col("text")).items()))


_WRONG, _RIGHT = tx.cp1251_pairs()
_GARBLED = "CASE doc_id % 8 WHEN 0 THEN translate(concat(repeat('Съешь ещё этих мягких булок. ', 5), doc_id), {0}, {1}) WHEN 4 THEN translate(text, {0}, {1}) WHEN 1 THEN repeat('abcÀde ', 30) WHEN 2 THEN repeat('abcÀde 1234567890123456 ', 30) WHEN 3 THEN 'Х.' ELSE text END"


def _letters_sql(of: str, prefix: str) -> str:
    classes = {"cyr": "[^Ѐ-ӿ]", "sup": "[^À-ÿ]", "asc": "[^a-zA-Z]", "oth": r"[^\p{L}]|[Ѐ-ӿÀ-ÿa-zA-Z]"}
    return ", ".join(f"length(regexp_replace({of}, '{c}', '', 'g')) AS {prefix}_{n}" for n, c in classes.items())


@query("mojibake", rf"""WITH x AS (SELECT doc_id, {_GARBLED.format(f"'{_RIGHT}'", f"'{_WRONG}'")} AS t FROM documents), f AS (SELECT *, translate(t, '{_WRONG}', '{_RIGHT}') AS f FROM x),
c AS (SELECT *, {_letters_sql('t', 'r')}, {_letters_sql('f', 'g')}, regexp_replace(t, '\s', '', 'g') AS solid FROM f),
n AS (SELECT *, r_cyr + r_sup + r_asc + r_oth AS r, g_cyr + g_sup + g_asc + g_oth AS g, CASE WHEN length(solid) = 0 THEN 0 ELSE length(regexp_replace(solid, '[^\p{{L}}]', '', 'g')) / length(solid) END AS dense FROM c),
k AS (SELECT *, CASE WHEN r < {tx.FEWEST_LETTERS} THEN 'no_text_layer' WHEN r_cyr / nullif(r, 0) >= {tx.CYRILLIC_CLEAN} THEN 'clean' WHEN r_sup / nullif(r, 0) <= {tx.LATIN_STRAY} THEN 'clean'
  WHEN g_cyr / nullif(g, 0) >= {tx.CYRILLIC_CLEAN} THEN 'mojibake_recovered' WHEN dense >= {tx.DENSE_ENOUGH} THEN 'degraded' ELSE 'broken' END AS category FROM n)
SELECT doc_id, category, CASE category WHEN 'clean' THEN 'clean' WHEN 'mojibake_recovered' THEN 'recoded' WHEN 'degraded' THEN 'degraded' ELSE 'unreadable' END AS state,
  md5(CASE WHEN category = 'mojibake_recovered' THEN f ELSE t END) AS text_md5 FROM k""")
def _(s, d):
    text = F.expr(_GARBLED.format(f"'{_RIGHT}'", f"'{_WRONG}'"))
    done = tx.classify_text(table(s, d, "documents").select("doc_id", text.alias("text")), "text")
    return done.select("doc_id", "category", tx.extraction_state(F.col("category")).alias("state"), F.md5("recovered").alias("text_md5"))


@query("page_split", "WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), k AS (SELECT doc_id, CASE WHEN len(l) > 1 AND trim(l[-1], ' ' || chr(9) || chr(13) || chr(10)) = '' THEN l[:-2] ELSE l END AS l FROM p) SELECT doc_id AS document_id, unnest(range(1, len(l) + 1))::INT AS page_number, unnest(l) AS body FROM k")
def _(s, d):
    return text_sources.split_pages(table(s, d, "documents"), "doc_id", F.col("text"), "\n")


@query("pending_keys", f"WITH {PAGES} SELECT id FROM pg WHERE embedding IS NULL AND trim(body, ' ') <> ''")
def _(s, d):
    return merge.pending(_pages(s, d), F.col("body")).select("id")


@query("backfill_parse", f"""{with_sql('journal')} SELECT id, coalesce(node_key, nullif(regexp_extract(reason, 'node=([^ ]+)', 1), ''), nullif(regexp_extract(reason, 'seed=([^ ]+)', 1), '')) AS node_key,
  nullif(regexp_extract(reason, 'score=(-?[0-9.]+)', 1), '')::DOUBLE AS score, nullif(regexp_extract(reason, 'tau=(-?[0-9.]+)', 1), '')::DOUBLE AS tau,
  nullif(regexp_extract(reason, 'relation=([a-z]+)', 1), '') AS relation, nullif(regexp_extract(reason, 'cited_by_count=([0-9]+)', 1), '')::BIGINT AS cited_by_count FROM journal""")
def _(s, d):
    f = tx.journal_fields(F.col("reason"))
    return load(s, d, "journal").select("id", F.coalesce("node_key", f["node_key"]).alias("node_key"), *(f[c].alias(c) for c in ("score", "tau", "relation", "cited_by_count")))


# --- merges ----------------------------------------------------------------------------
def _work_tables(s, d) -> tuple[DataFrame, DataFrame]:
    w = load(s, d, "works").select("key", "title", "year", "kind", "document_id", F.lit("first").alias("source"))
    old = w.filter("substring(key, 2) % 3 != 0")
    new = w.filter("substring(key, 2) % 2 = 0").withColumns({"title": F.when(F.col("year") % 5 != 0, F.concat("title", F.lit(" again"))), "kind": F.lit("external-skeleton"), "source": F.lit("second")})
    return old, new


@query("work_upsert", f"""{with_sql('works')}, o AS (SELECT * FROM works WHERE id % 3 <> 0), n AS (SELECT id, key, CASE WHEN year % 5 <> 0 THEN title || ' again' END AS title, year, document_id FROM works WHERE id % 2 = 0)
SELECT coalesce(n.key, o.key) AS key, coalesce(n.title, o.title) AS title, coalesce(n.year, o.year) AS year,
  CASE WHEN n.key IS NULL OR o.kind = 'our-document' THEN o.kind ELSE 'external-skeleton' END AS kind, coalesce(n.document_id, o.document_id) AS document_id, CASE WHEN n.key IS NULL THEN 'first' ELSE 'second' END AS source
FROM o FULL JOIN n ON o.key = n.key""")
def _(s, d):
    return merge.upsert_works(*_work_tables(s, d))


@query("page_upsert", f"WITH {PAGES}, o AS (SELECT * FROM pg WHERE document_id % 3 <> 0), n AS (SELECT document_id, page_number, CASE WHEN page_number % 2 = 0 OR document_id % 4 = 0 THEN body || '!' ELSE body END AS body FROM pg WHERE document_id % 2 = 0) SELECT coalesce(n.document_id, o.document_id) AS document_id, coalesce(n.page_number, o.page_number)::INT AS page_number, CASE WHEN n.document_id IS NULL THEN o.body ELSE n.body END AS body, (CASE WHEN n.document_id IS NULL OR n.body = o.body THEN o.embedding END) IS NOT NULL AS has_vector FROM o FULL JOIN n ON o.document_id = n.document_id AND o.page_number = n.page_number")
def _(s, d):
    pages = _pages(s, d).select("document_id", "page_number", "body", "embedding")
    body = F.when((F.col("page_number") % 2 == 0) | (F.col("document_id") % 4 == 0), F.concat("body", F.lit("!"))).otherwise(F.col("body"))
    staged = pages.filter("document_id % 2 = 0").select("document_id", "page_number", body.alias("body"))
    return merge.upsert_pages(pages.filter("document_id % 3 != 0"), staged).select("document_id", "page_number", "body", F.col("embedding").isNotNull().alias("has_vector"))


@query("document_upsert", f"""{with_sql('corpus')}, o AS (SELECT id, source_dir, extraction_state, chars_extracted FROM corpus WHERE id % 7 <> 0), n AS (SELECT id, 'theory/iis' AS source_dir, 'degraded' AS extraction_state, chars_extracted + 1 AS chars_extracted FROM corpus WHERE id % 2 = 0)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN t THEN n.source_dir ELSE o.source_dir END AS source_dir, CASE WHEN t THEN n.extraction_state ELSE o.extraction_state END AS extraction_state, CASE WHEN t THEN n.chars_extracted ELSE o.chars_extracted END AS chars_extracted
FROM (SELECT o, n, n.id IS NOT NULL AND (o.id IS NULL OR (o.extraction_state NOT IN ('transcribed', 'ocr', 'metadata') AND o.source_dir = 'theory/iis')) AS t FROM o FULL JOIN n ON o.id = n.id)""")
def _(s, d):
    docs = load(s, d, "corpus").select("id", "source_dir", "extraction_state", "chars_extracted")
    staged = docs.filter("id % 2 = 0").select("id", F.lit("theory/iis").alias("source_dir"), F.lit("degraded").alias("extraction_state"), (F.col("chars_extracted") + 1).alias("chars_extracted"))
    return merge.upsert_documents(docs.filter("id % 7 != 0"), staged, "theory/iis")


@query("cites_insert", f"{with_sql('works', 'cites')} SELECT DISTINCT c.citing, c.cited, 'new' AS source FROM cites c JOIN works a ON a.id = c.citing JOIN works b ON b.id = c.cited WHERE c.citing <> c.cited")
def _(s, d):
    works, cites = load(s, d, "works"), load(s, d, "cites")
    name = lambda c: F.concat(F.lit("W"), F.col(c).cast("string"))
    staged = cites.select(name("citing").alias("citing_key"), name("cited").alias("cited_key"), F.lit("new").alias("source"))
    odd = staged.limit(1).select(F.lit("W0").alias("citing_key"), F.lit("W0").alias("cited_key"), "source").union(staged.limit(1).select("citing_key", F.lit("nobody").alias("cited_key"), "source"))
    return merge.insert_edges(cites, works, staged.union(odd).union(staged))


@query("promote_twins", f"{with_sql('works')} SELECT key, CASE WHEN id % 50 = 1 THEN 'our-document' ELSE kind END AS kind, CASE WHEN id % 50 = 1 THEN id + 1 ELSE document_id END AS document_id, CASE WHEN id % 50 = 1 THEN 'W' || (id + 1) END AS twin_of FROM works")
def _(s, d):
    works = load(s, d, "works").withColumn("evidence", F.create_map(F.lit("seen"), F.lit("yes")))
    twins = works.filter("id % 50 = 1").select("key", (F.col("id") + 1).alias("document_id"), F.concat(F.lit("W"), F.col("id") + 1).alias("twin_of"), F.lit("title+year").alias("twin_rule"))
    return merge.promote_twins(works, twins).select("key", "kind", "document_id", F.col("evidence")["twin_of"].alias("twin_of"))


@query("vanish_delete", f"{with_sql('corpus')} SELECT id FROM corpus WHERE id % 2 = 0 OR source_dir <> 'theory/iis' OR extraction_state IN ('transcribed', 'metadata')")
def _(s, d):
    docs = load(s, d, "corpus")
    mine = (F.col("source_dir") == "theory/iis") & ~F.col("extraction_state").isin("transcribed", "metadata", "ocr")
    return merge.delete_vanished(docs, docs.filter("id % 2 = 0"), mine).select("id")


# --- publication -----------------------------------------------------------------------
_SHIPS = "coalesce(public_distribution IN ('full-text', 'metadata-only', 'internal'), false)"


@query("legal_summary", f"{with_sql('corpus')} SELECT coalesce(legal_class, '') AS legal_class, coalesce(public_distribution, '') AS public_distribution, count(*) AS documents, coalesce(string_agg(DISTINCT legal_note, '; ' ORDER BY legal_note), '') AS notes FROM corpus GROUP BY 1, 2")
def _(s, d):
    return publish.legal_summary(load(s, d, "corpus"))


@query("unclassified_documents", f"{with_sql('corpus')} SELECT id, coalesce(legal_class, '') AS legal_class, coalesce(public_distribution, '') AS public_distribution FROM corpus WHERE legal_class IS NULL OR public_distribution IS NULL OR legal_note IS NULL")
def _(s, d):
    return publish.unclassified(load(s, d, "corpus"))


@query("distribution_census", f"{with_sql('corpus')}, k AS (SELECT unnest(['full-text', 'metadata-only', 'internal', 'excluded']) AS public_distribution), c AS (SELECT coalesce(public_distribution, '') AS public_distribution, count(*) AS n FROM corpus GROUP BY 1) SELECT coalesce(k.public_distribution, c.public_distribution) AS public_distribution, coalesce(n, 0)::BIGINT AS n FROM k FULL JOIN c ON k.public_distribution = c.public_distribution")
def _(s, d):
    return publish.by_distribution(load(s, d, "corpus"))


@query("public_documents", f"{with_sql('corpus')} SELECT id, public_distribution FROM corpus WHERE {_SHIPS}")
def _(s, d):
    return publish.public_documents(load(s, d, "corpus")).select("id", "public_distribution")


@query("public_pages", f"{with_sql('corpus')}, {PAGES} SELECT p.document_id, p.page_number::INT AS page_number, CASE WHEN c.public_distribution IN ('full-text', 'internal') THEN p.body ELSE '' END AS body FROM pg p JOIN corpus c ON c.id = p.document_id WHERE {_SHIPS}")
def _(s, d):
    return publish.public_pages(_pages(s, d).select("document_id", "page_number", "body"), load(s, d, "corpus"))


_KEPT_WORKS = f"kept AS (SELECT w.* FROM works w WHERE w.document_id IS NULL OR w.document_id IN (SELECT id FROM corpus WHERE {_SHIPS}))"


@query("public_work", f"{with_sql('works', 'corpus')}, {_KEPT_WORKS} SELECT id, key, kind, NULL::VARCHAR AS abstract FROM kept")
def _(s, d):
    works = load(s, d, "works").withColumn("abstract", F.col("title"))
    return publish.public_works(works, load(s, d, "corpus"), "topology-only").select("id", "key", "kind", "abstract")


@query("public_edges", f"{with_sql('works', 'corpus', 'cites')}, {_KEPT_WORKS} SELECT * FROM cites WHERE citing IN (SELECT id FROM kept) AND cited IN (SELECT id FROM kept)")
def _(s, d):
    return publish.public_edges(load(s, d, "cites"), publish.public_works(load(s, d, "works"), load(s, d, "corpus"), "full-skeleton"))


_NAMES = f"names AS (SELECT id::VARCHAR AS ref FROM corpus WHERE NOT {_SHIPS} UNION SELECT w.key FROM works w WHERE w.document_id IN (SELECT id FROM corpus WHERE NOT {_SHIPS}))"


@query("journal_cut", f"{with_sql('journal', 'works', 'corpus')}, {_NAMES} SELECT id FROM journal j WHERE NOT EXISTS (SELECT 1 FROM names WHERE ref = frontier_key) AND NOT EXISTS (SELECT 1 FROM names WHERE ref = candidate_key) AND NOT EXISTS (SELECT 1 FROM names WHERE ref = node_key)")
def _(s, d):
    return publish.public_journal(load(s, d, "journal"), load(s, d, "works"), load(s, d, "corpus")).select("id")


@query("leak_sample", f"{with_sql('journal')}, l AS (SELECT id FROM journal WHERE reason LIKE 'node=%') SELECT (SELECT count(*) FROM l) AS total, id FROM l ORDER BY id LIMIT 20")
def _(s, d):
    total, first = publish.leak_sample(load(s, d, "journal"), F.col("reason").startswith("node="), "id")
    return s.createDataFrame([(total, x) for x in first], "total long, id long")


@query("table_rows", 'SELECT * FROM (VALUES (\'orders\', (SELECT count(*) FROM orders)), (\'events\', (SELECT count(*) FROM events)), (\'documents\', (SELECT count(*) FROM documents))) t("table", "rows")')
def _(s, d):
    return publish.manifest_counts({t: table(s, d, t) for t in ("orders", "events", "documents")})


# --- checks ----------------------------------------------------------------------------
@query("unplaced_documents", f"{with_sql('corpus', 'works', 'journal')} SELECT id FROM corpus d WHERE source_dir = 'theory/iis' AND extraction_state <> 'metadata' AND id NOT IN (SELECT document_id FROM works WHERE kind = 'our-document' AND document_id IS NOT NULL) AND id::VARCHAR NOT IN (SELECT frontier_key FROM journal WHERE action = 'seed-missing')")
def _(s, d):
    return checks.unplaced_documents(load(s, d, "corpus"), load(s, d, "works"), load(s, d, "journal"), "theory/iis")


@query("dangling_evidence", "SELECT DISTINCT conv_id AS run_id, conv_id * 37 + turn AS document_id FROM conversations WHERE conv_id * 37 + turn NOT IN (SELECT doc_id FROM documents)")
def _(s, d):
    runs = table(s, d, "conversations").groupBy(F.col("conv_id").alias("run_id")).agg(F.collect_list(F.col("conv_id") * 37 + F.col("turn")).alias("evidence_docs"))
    return checks.dangling_evidence(runs, table(s, d, "documents").select(F.col("doc_id").alias("id")))


@query("no_semantic_key", f"WITH {PAGES} SELECT count(*) AS n FROM pg WHERE trim(body, ' ') <> '' AND embedding IS NULL")
def _(s, d):
    return checks.no_semantic_key(_pages(s, d), F.col("body"))


@query("self_loops", "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey = l_partkey")
def _(s, d):
    return checks.self_loops(load(s, d, "baskets"))


@query("vocabulary_violations", f"{with_sql('journal')} SELECT 'action' AS \"check\", action AS subject, count(*)::VARCHAR AS detail FROM journal WHERE action NOT IN ('keep', 'drop') GROUP BY action")
def _(s, d):
    return checks.outside_vocabulary(load(s, d, "journal"), "action", ("keep", "drop"), "action")


@query("orphan_edges", "SELECT DISTINCT 'edge-to-work' AS \"check\", l_partkey::VARCHAR AS subject, '' AS detail FROM lineitem WHERE l_partkey NOT IN (SELECT vec_id FROM embeddings)")
def _(s, d):
    return checks.orphans(load(s, d, "baskets"), "cited", load(s, d, "works"), "id", "edge-to-work")


@query("count_mismatch", "SELECT o_orderstatus AS k, n AS declared, CASE WHEN o_orderstatus = 'F' THEN n + 1 ELSE n END AS actual FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) WHERE o_orderstatus = 'F'")
def _(s, d):
    a = table(s, d, "orders").groupBy(F.col("o_orderstatus").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return checks.compare_counts(a, a.withColumn("n", F.when(F.col("k") == "F", F.col("n") + 1).otherwise(F.col("n"))), "k", "n")


# --- exports, seeds, dumps, crawl ------------------------------------------------------
def _pairs(s, d) -> DataFrame:
    from pyspark.sql import Window

    top = graph.cocitation(load(s, d, "parts"), load(s, d, "baskets"), limit=100)
    return top.withColumn("position", F.row_number().over(Window.orderBy(F.col("count").desc(), "a_key", "b_key")))


_PAIRS = f"pairs AS (SELECT row_number() OVER (ORDER BY \"count\" DESC, a_key, b_key) AS position, * FROM ({_cocitation_sql(200, 100)}))"
_MAP = "ends AS (SELECT position, 0 AS side, a_key AS key, a_title AS title FROM pairs UNION ALL SELECT position, 1, b_key, b_title FROM pairs), m AS (SELECT row_number() OVER (ORDER BY min(position * 2 + side))::INT AS id, coalesce(nullif(any_value(title), ''), key) AS label, key FROM ends GROUP BY key)"


@query("vosviewer_map", f"WITH {_PAIRS}, {_MAP} SELECT * FROM m")
def _(s, d):
    return snapshots.vosviewer_map(_pairs(s, d))


@query("vosviewer_network", f"WITH {_PAIRS}, {_MAP} SELECT a.id AS id1, b.id AS id2, p.\"count\" AS weight FROM pairs p JOIN m a ON a.key = p.a_key JOIN m b ON b.key = p.b_key")
def _(s, d):
    pairs = _pairs(s, d)
    return snapshots.vosviewer_network(pairs, snapshots.vosviewer_map(pairs))


@query("seed_status", f"{with_sql('corpus')} SELECT c.id, CASE WHEN e.vec_id IS NULL THEN 'seed-missing' ELSE 'seed' END AS action FROM corpus c LEFT JOIN embeddings e ON e.vec_id = c.id WHERE source_dir = 'theory/iis' AND extraction_state <> 'metadata'")
def _(s, d):
    seeds = load(s, d, "corpus").filter("source_dir = 'theory/iis' AND extraction_state != 'metadata'").select(F.col("id").alias("document_id"), F.concat(F.lit("W"), "id").alias("id"))
    none = F.array().cast("array<string>")
    records = load(s, d, "works").select(F.col("key").alias("id"), F.concat(F.lit("10.1/"), "key").alias("doi"), "title", "year", F.lit(0).alias("cited_by_count"), none.alias("refs"), "embedding")
    ball = crawl.Snowball(records, snapshots.scratch(s), tau=0.5)
    ball.seed(seeds)
    return ball.steps().select(F.col("frontier_key").cast("long").alias("id"), "action")


@query("citers_of_records", f"{with_sql('cites')} SELECT DISTINCT citing AS id, cited FROM cites")
def _(s, d):
    records = load(s, d, "cites").groupBy(F.col("citing").alias("id")).agg(F.collect_set("cited").alias("refs"))
    return text_sources.citers_of(records, load(s, d, "works").select("id"))


@query("dump_scan", "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS ordinal, p_partkey::VARCHAR AS p_partkey, p_name FROM part")
def _(s, d):
    folder = f"{snapshots.shared_dir(s)}/dump-{uuid.uuid4().hex}"
    lines = copy_dump.copy_lines(table(s, d, "part"), "public", "part").coalesce(1).sortWithinPartitions("ordinal").select("line")
    lines.write.text(folder)
    return copy_dump.table_of(copy_dump.read_dump(s, f"{folder}/part-*"), "public", "part", ["p_partkey", "p_name"])


def _level_sql(n: int, known: str) -> str:
    """Nodes of level n: cites one of the level before that is no hub, or is cited by one."""
    near = f"SELECT citing AS id FROM cites JOIN l{n - 1} f ON f.id = cited WHERE f.id % 100 <= 95 UNION SELECT cited FROM cites JOIN l{n - 1} f ON f.id = citing"
    return f"l{n} AS (SELECT id FROM scores WHERE score >= 0.05 AND id IN ({near}) AND id NOT IN ({known}))"


@query("crawl_levels", f"""{with_sql('works', 'cites')}, {DOUBLES}, l0 AS (SELECT id FROM works WHERE kind = 'our-document'),
unit AS (SELECT [x / sqrt(list_inner_product(embedding, embedding)) for x in embedding] AS v FROM w WHERE kind = 'our-document' AND embedding IS NOT NULL),
mean AS (SELECT i, avg(x) AS m FROM (SELECT unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM unit) GROUP BY i), target AS (SELECT list(m ORDER BY i) AS v FROM mean),
scores AS (SELECT id, CASE WHEN embedding IS NULL THEN -1 ELSE {COS.format(a='embedding', b='t.v')} END AS score FROM w, target t),
{_level_sql(1, 'SELECT id FROM l0')}, {_level_sql(2, 'SELECT id FROM l0 UNION ALL SELECT id FROM l1')}
SELECT 0 AS depth, count(*) AS nodes FROM l0 HAVING count(*) > 0 UNION ALL SELECT 1, count(*) FROM l1 HAVING count(*) > 0 UNION ALL SELECT 2, count(*) FROM l2 HAVING count(*) > 0""")
def _(s, d):
    works, cites = load(s, d, "works"), load(s, d, "cites")
    refs = cites.groupBy(F.col("citing").alias("id")).agg(F.collect_set(F.concat(F.lit("W"), F.col("cited"))).alias("refs"))
    records = works.join(refs, "id", "left").select(F.col("key").alias("id"), F.concat(F.lit("10.1/"), "key").alias("doi"), "title", "year", (F.col("id") % 100).alias("cited_by_count"), F.coalesce("refs", F.array().cast("array<string>")).alias("refs"), "embedding")
    ball = crawl.Snowball(records, snapshots.scratch(s), tau=0.05, hub_cap=95)
    ball.seed(works.filter("kind = 'our-document'").select(F.col("document_id"), F.col("key").alias("id")))
    return ball.run(2).groupBy("depth").agg(F.count(F.lit(1)).alias("nodes"))


from folioscope.plans import package_queries  # noqa: E402, F401  (adds its queries)
from folioscope.plans import store_queries  # noqa: E402, F401

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions import vectors as vec
from folioscope.functions.stemmer import analyze, stem
from folioscope.operators import checks, crawl, graph, merge, publish, retrieval, stats
from folioscope.plans import registry, standins
from folioscope.sources import copy_dump, snapshots, text_sources

WORK = "id long, key string, title string, year int, kind string, document_id long, embedding array<float>"
CITE = "citing long, cited long, source string"


def works(spark, *rows):
    return spark.createDataFrame([(i, k, k.upper(), 2000 + i, kind, doc, v) for i, k, kind, doc, v in rows], WORK)


def test_citers_and_cycle(spark):
    w = works(spark, (1, "a", graph.OURS, 10, None), (2, "b", graph.SKELETON, None, None), (3, "c", graph.SKELETON, None, None))
    c = spark.createDataFrame([(2, 1, "x"), (2, 1, "y"), (3, 2, "x"), (1, 3, "x")], CITE)
    keys = lambda d: [r["key"] for r in graph.citers(w, c, 10, d).collect()]
    assert keys(1) == ["b"] and keys(2) == ["b", "c"] and keys(3) == ["a", "b", "c"]
    assert graph.citers(w, c, 99).count() == 0
    with pytest.raises(ValueError):
        graph.citers(w, c, 10, 4)


def test_links_count_documents_once(spark):
    v = [1.0, 0.0]
    w = works(spark, (1, "a", graph.OURS, 10, v), (2, "b", graph.SKELETON, None, v), (3, "c", graph.SKELETON, None, v))
    c = spark.createDataFrame([(2, 1, "x"), (2, 1, "y"), (1, 2, "x")], CITE)
    got = {r["key"]: (r["score"], r["links"]) for r in graph.candidates(w, c).collect()}
    assert got == {"b": (1.0, 1), "c": (1.0, 0)}
    assert [r["key"] for r in graph.candidates(w, c, min_links=1).collect()] == ["b"]


def test_cocitation_cap_and_limit(spark):
    w = works(spark, *((i, k, graph.SKELETON, None, None) for i, k in enumerate("xyz")))
    fat = spark.createDataFrame([(9, 0, "s"), (9, 1, "s"), (9, 2, "s"), (8, 0, "s"), (8, 1, "s")], CITE)
    pairs = lambda **k: [(r["a_key"], r["b_key"], r["count"]) for r in graph.cocitation(w, fat, min_count=1, **k).collect()]
    assert pairs(max_out_degree=3) == [("x", "y", 2), ("x", "z", 1), ("y", "z", 1)]
    assert pairs(max_out_degree=2) == [("x", "y", 1)]
    assert len(pairs(limit=2)) == 2
    assert graph.cocitation(w, fat.limit(0)).count() == 0


def test_stale_projection_is_a_fault(spark):
    a = works(spark, (1, "a", graph.OURS, 10, None))
    b = works(spark, (1, "b", graph.OURS, 10, None))
    none = spark.createDataFrame([], CITE)
    assert graph.projection_faults(graph.projection_digest(a, none), graph.projection_digest(a, none)) == []
    assert graph.projection_faults(graph.projection_digest(a, none), graph.projection_digest(b, none))


def test_cosine_and_centroid(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    got = row.select(vec.cosine(F.col("a"), vec.literal([3, 4])), vec.cosine(F.col("a"), F.col("z")), vec.l2_normalize(F.col("a"))).first()
    assert got[0] == pytest.approx(1) and got[1] == 0.0 and got[2] == pytest.approx([0.6, 0.8])
    with pytest.raises(Exception, match="widths"):
        row.select(vec.cosine(F.col("a"), vec.literal([1, 2, 3]))).collect()
    c = graph.centroid_unit(spark.createDataFrame([([100.0, 0.0],), ([0.0, 0.01],)], "embedding array<float>"))
    assert c[0] == pytest.approx(c[1])
    with pytest.raises(ValueError):
        graph.centroid_unit(spark.createDataFrame([], "embedding array<float>"))


def test_threshold_and_quantiles(spark):
    s = spark.createDataFrame([(0.5,), (0.6,), (0.5 - 1e-12,)], "score double")
    assert s.filter(stats.keeps(F.col("score"), 0.5)).count() == 2
    v = spark.createDataFrame([(float(i),) for i in range(6)], "score double")
    assert [r["value"] for r in stats.quantiles(v, points=(0.5,)).collect()] == [2.0]  # 2.5 rounds to even
    h = stats.histogram(v, bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 1, 1, 2]
    assert [r["count"] for r in stats.histogram(spark.createDataFrame([(1.0,), (1.0,)], "score double")).collect()] == [2]
    assert stats.suggest_tau(v.limit(1)) is None
    gap = spark.createDataFrame([(0.10,), (0.50,), (0.51,), (0.52,), (0.53,)], "score double")
    assert 0.1 < stats.suggest_tau(gap, width=0.05) < 0.5


def test_text_rules(spark):
    row = spark.createDataFrame([(" A\n", None, r"\alpha Ёж $x$ 1", "https://doi.org/10.1070/RM9846.,", {"a": [0, 3], "b": [1]})], "t string, n string, tex string, doi string, inv map<string,array<int>>")
    got = row.select(tx.works_text(F.col("t"), F.col("n")), tx.normalize_title(F.col("tex")), tx.doi_suffix(F.col("doi")), tx.normalize_doi(F.col("doi")), tx.restore_abstract(F.col("inv"))).first()
    assert list(got) == ["A", "ежx1", "rm9846", "10.1070/rm9846", "a b a"]
    years = spark.createDataFrame([(2001, [2000]), (2003, [2000]), (None, [2000]), (None, [])], "y int, k array<int>")
    assert [r[0] for r in years.select(tx.year_matches(F.col("y"), F.col("k"))).collect()] == [True, False, False, True]


def test_encoding_classes(spark):
    cyrillic = "проверка кодировки текста на русском языке, достаточно длинная для того чтобы судить"
    wrong = cyrillic.encode("cp1251").decode("latin-1")
    rows = spark.createDataFrame([("c", cyrillic), ("m", wrong), ("e", "plain english text " * 5), ("n", "   \n\f   123 456 \n")], "k string, t string")
    got = {r["k"]: (r["category"], r["recovered"]) for r in tx.classify_text(rows, "t").collect()}
    assert got["m"] == ("mojibake_recovered", cyrillic)
    assert [got[k][0] for k in "cen"] == ["clean", "clean", "no_text_layer"]


def test_russian_stems():
    words = {"вагоны": "вагон", "важная": "важн", "важнейшие": "важн", "вечерами": "вечер", "книгами": "книг", "сделавшись": "сдела"}
    assert {w: stem(w) for w in words} == words
    assert analyze("дом и сад") == ["дом", "", "сад"]


def test_search_modes(spark):
    pages = spark.createDataFrame([(1, 1, 1, "red fish blue fish", [1.0, 0.0]), (2, 1, 2, "fish red", [0.0, 1.0]), (3, 2, 1, "Red, fish", None)], "id long, document_id long, page_number int, body string, embedding array<float>")
    found, notice = retrieval.search(pages, "red fish")
    assert [(r["document_id"], r["page_number"]) for r in found.collect()] == [(1, 1), (2, 1)] and notice is None
    _, notice = retrieval.search(pages, "red fish", "hybrid")
    assert notice
    both, notice = retrieval.search(pages, "red fish", "hybrid", embed=lambda q: [0.0, 1.0])
    assert notice is None and both.count() == 3
    assert retrieval.fulltext(pages, "no such").count() == 0


def test_merges(spark):
    old = spark.createDataFrame([("a", "t", "our-document", "s1"), ("x", None, "excluded", "s1")], "key string, title string, kind string, source string")
    new = spark.createDataFrame([("a", None, "external-skeleton", "s2"), ("x", "n", "external-skeleton", "s2")], old.schema)
    got = {r["key"]: (r["title"], r["kind"], r["source"]) for r in merge.upsert_works(old, new).collect()}
    assert got == {"a": ("t", "our-document", "s2"), "x": ("n", "external-skeleton", "s2")}
    with pytest.raises(ValueError):
        merge.upsert_works(old, new.union(new))
    p = "document_id long, page_number int, body string, embedding array<float>"
    pages = spark.createDataFrame([(1, 1, "same", [1.0]), (1, 2, "old", [1.0])], p)
    kept = merge.upsert_pages(pages, spark.createDataFrame([(1, 1, "same"), (1, 2, "new"), (2, 1, "more")], "document_id long, page_number int, body string"))
    assert {(r["document_id"], r["page_number"]): r["embedding"] for r in kept.collect()} == {(1, 1): [1.0], (1, 2): None, (2, 1): None}


def test_publication_refuses_to_guess(spark):
    docs = spark.createDataFrame([("d1", "c", "full-text", "n"), ("d2", "c", "metadata-only", "n"), ("d3", "c", "excluded", "n"), ("d4", None, None, None)], "id string, legal_class string, public_distribution string, legal_note string")
    with pytest.raises(ValueError, match="d4"):
        publish.require_classified(docs)
    with pytest.raises(ValueError):
        publish.require_mode("everything")
    pages = spark.createDataFrame([(d, 1, "body") for d in ("d1", "d2", "d3", "d4")], "document_id string, page_number int, body string")
    assert {r["document_id"]: r["body"] for r in publish.public_pages(pages, docs).collect()} == {"d1": "body", "d2": ""}


def test_checks(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, p int")
    v = checks.verdicts({"twice": checks.duplicate_keys(rows, ["k"]), "orphans": checks.orphans(rows, "p", rows.filter("p = 1"), "p", "x"), "later": None})
    assert {r["name"]: r["ok"] for r in v.collect()} == {"twice": False, "orphans": True, "later": None}
    assert checks.gates([("a", True, ""), ("b", False, ""), ("c", True, "")])[2][1] is None
    assert checks.probe_verdict(2, 1, 0.0, 0.1)[0] and not checks.probe_verdict(3, 1, 0.0, 0.1)[0]


def test_dump_reader(spark, tmp_path):
    good = "-- head\nCOPY corpus.pages (id, body) FROM stdin;\n1\ta\\tb\n2\t\\N\n\\.\n"
    (tmp_path / "a.gz").write_bytes(gzip.compress(good.encode()))
    got = copy_dump.table_of(copy_dump.read_dump(spark, f"file://{tmp_path}/a.gz"), "corpus", "pages", ["id", "body"])
    assert [(r["id"], r["body"]) for r in got.orderBy("ordinal").collect()] == [("1", "a\tb"), ("2", None)]
    for bad in (good.replace("\\.\n", ""), good.replace("2\t\\N", "2")):
        with pytest.raises(copy_dump.DumpError):
            list(copy_dump.scan_lines(iter(bad.splitlines(keepends=True))))


def test_split_dumps_read_as_whole_ones(spark, tmp_path):
    blocks, want = ["-- head"], []
    for t, size in (("a", 40), ("b", 0), ("c", 7), ("d", 90)):
        blocks += [f"COPY s.{t} (x) FROM stdin;", *(f"COPY s.z (x) FROM stdin;" if i == 5 else f"{t}{i} é" for i in range(size)), "\\.", "", "SELECT 1;"]
        want += [(t, i, "COPY s.z (x) FROM stdin;" if i == 5 else f"{t}{i} é") for i in range(size)]
    (tmp_path / "a.sql").write_text("\n".join(blocks) + "\n", encoding="utf-8")
    (tmp_path / "open.sql").write_text("\n".join(blocks[:30]) + "\n", encoding="utf-8")
    (tmp_path / "bad.sql").write_bytes(b"COPY s.a (x) FROM stdin;\n\xff\n\\.\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for width in ("97b", "700b", "1m"):
            for n in names:
                spark.conf.set(n, width)
            dump = copy_dump.read_dump(spark, f"file://{tmp_path}/a.sql")
            assert sorted((r["table"], r["ordinal"], r["fields"][0]) for r in dump.collect()) == sorted(want)
            for file in ("open.sql", "bad.sql"):
                with pytest.raises(Exception, match="ends inside|can't decode"):
                    copy_dump.read_dump(spark, f"file://{tmp_path}/{file}").collect()
    finally:
        for n in names:
            spark.conf.set(n, before[n])


def test_registry_problems(spark):
    head = "| " + " | ".join(text_sources.REGISTRY_COLUMNS) + " |"
    lines = ["prose", head, "|---|---|---|---|---|---|", "| a.pdf | t | https://x | l | b | r |", "| a.pdf | t | ftp://x | l | b |  |", "| b.exe | t |"]
    rows, bad = text_sources.parse_registry(spark.createDataFrame(list(enumerate(lines)), "number long, value string"))
    assert rows.count() == 2
    assert {(r["number"], r["problem"]) for r in bad.collect()} == {(4, "url"), (4, "blank reason"), (4, "given twice"), (5, "number of cells")}


def test_snapshot_versions(spark, tmp_path):
    t = f"file://{tmp_path}/t"
    assert snapshots.publish(spark.range(3), t) == 3
    assert snapshots.publish(spark.range(5), t) == 5
    assert snapshots.read(spark, t).count() == 5


def test_snapshot_writers_dont_lose_each_other(spark, tmp_path):
    t = f"file://{tmp_path}/t"
    snapshots.publish(spark.range(3), t)
    seen = snapshots.current(spark, t)
    snapshots.publish(spark.range(4), t, after=seen)
    with pytest.raises(RuntimeError):
        snapshots.publish(spark.range(9), t, after=seen)
    assert snapshots.read(spark, t).count() == 4


def test_russian_phrases_keep_their_distances(spark):
    """Stop words at the ends ask for nothing, inside they are a place any word may take."""
    texts = ["школа стоит", "и снова школа", "дом большой сад", "дом сад", "сад и дом", "и в на"]
    pages = spark.createDataFrame([(i, i, 1, t, None) for i, t in enumerate(texts)], "id long, document_id long, page_number int, body string, embedding array<float>")

    def found(query):
        return [r["document_id"] for r in retrieval.search(pages, query)[0].collect()]

    assert found("в школа") == found("школа") == [0, 1]
    assert found("дом и сад") == [2] and found("дом сад") == [3] and found("сад в доме") == [4]
    assert found("и") == [] and found("") == []


def test_ranks_over_many_partitions(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=999), 3)
    rows = spark.createDataFrame([(int(i), "ab"[i % 3 == 0], float(v)) for i, v in enumerate(x)], "id long, g string, score double")
    got = {r["point"]: r["value"] for r in stats.quantiles(rows).collect()}
    assert got == {p: sorted(x)[round(p * 998)] for p in stats.POINTS}
    q = {r["g"]: r for r in stats.quartiles(rows, "g").collect()}
    for g, mine in (("a", x[np.arange(999) % 3 != 0]), ("b", x[::3])):
        v = sorted(mine)
        assert (q[g]["n"], q[g]["p25"], q[g]["median"], q[g]["p75"]) == (len(v), v[len(v) // 4], v[len(v) // 2], v[3 * len(v) // 4])
    wide = stats.percentile_cont(rows, "score", (0.05, 0.5)).first()
    assert np.allclose([wide["low"], wide["p05"], wide["p50"], wide["high"]], [x.min(), *np.percentile(x, [5, 50]), x.max()])
    assert stats.quantiles(rows.limit(0)).count() == 0 and stats.percentile_cont(rows.limit(0), "score", (0.5,)).first()["p50"] is None
    pages = rows.select("id", (F.col("id") % 7).alias("document_id"), F.col("id").cast("int").alias("page_number"), F.array("score", F.lit(1.0)).alias("embedding"))
    ranks = retrieval.exact_ranks(pages, [1.0, 0.5]).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 1000))
    keys = [(r["distance"], r["document_id"], r["page_number"]) for r in ranks]
    assert keys == sorted(keys)


def test_gap_tau_by_hand(spark):
    scores = [0.1, 0.11, 0.3, 0.31, 0.5, 0.52, 0.54]
    rows = spark.createDataFrame([(x,) for x in scores], "score double")
    tau = stats.suggest_tau(rows, width=0.05)
    median, low = sorted(scores)[3], min(scores)
    filled = {int((x - low) / 0.05) for x in scores if x <= median}
    last = int((median - low) / 0.05)
    empty = max(b for b in range(last) if b not in filled)
    assert tau == pytest.approx(low + (empty + 0.5) * 0.05)


def test_a_node_grows_by_what_is_found_of_it_later(spark):
    unit = [1.0, 0.0]
    rows = [("S", "10.1/s", "", None, 5, ["R"], unit), ("T", "https://doi.org/10.1/S", "twin", 2003, 2, ["S", "R"], unit), ("R", "", "ref", 1999, 9, [], unit)]
    records = spark.createDataFrame(rows, "id string, doi string, title string, year int, cited_by_count long, refs array<string>, embedding array<float>")
    ball = crawl.Snowball(records, lambda df, n: spark.createDataFrame(df.collect(), df.schema), tau=0.5, hub_cap=100)
    ball.seed(spark.createDataFrame([("doc", "S")], "document_id string, id string"))
    node = {r["key"]: r for r in ball.run(1).collect()}
    assert set(node) == {"S", "R"}
    assert (node["S"]["title"], node["S"]["year"], node["S"]["cited_by_count"], node["S"]["depth"]) == ("twin", 2003, 7, 0)
    assert node["S"]["refs"] == ["R", "S"]


def test_restore_order_and_other_refusals(spark):
    from folioscope.operators import package_checks, runs
    from folioscope.sources import files

    order = package_checks.restore_order(["cites", "work", "run", "row"], [("cites", "work"), ("row", "run"), ("work", "work")])
    assert order == ["work", "cites", "run", "row"]
    with pytest.raises(ValueError):
        package_checks.restore_order(["a", "b"], [("a", "b"), ("b", "a")])
    assert package_checks.sets_agree(dump=["a", "b"], manifest=["a"], rule=["a", "b"]) == ["b: not in manifest"]
    assert package_checks.policy_problems({"mode": "x", "owner": " "}, ["topology-only"]) == ["unknown mode 'x'", "no owner"]
    assert files.scalar(spark.range(0)) is None and files.scalar(spark.range(1)) == 0
    with pytest.raises(ValueError):
        files.scalar(spark.range(2))
    with pytest.raises(ValueError):
        files.only_row(spark.range(1), 2)
    with pytest.raises(ValueError):
        files.ocr_pages(spark.createDataFrame([("a", "x\fy\f")], "path string, text string"), spark.createDataFrame([("a", 3)], "path string, pages int")).count()
    assert files.absent_tables({"a": spark.range(1), "b": None}, ["a", "b", "c"]) == ["b", "c"]
    scores = spark.createDataFrame([(f"k{i}", 0.1 + (i > 2) * 0.4 + i / 1000) for i in range(9)], "candidate_key string, score double")
    table = spark.createDataFrame([(7, "spike", 0.1)], "id long, spike string, tau double")
    rows = spark.createDataFrame([(7, "old", 0.9)], "run_id long, candidate_key string, score double")
    table, rows, tau = runs.record_calibration(scores, table, rows, "spike")
    assert table.first()["id"] == 8 and rows.count() == 9 and {r["run_id"] for r in rows.collect()} == {8} and tau is not None
    with pytest.raises(runs.NothingToMeasure):
        runs.record_calibration(scores.limit(0), table, rows)
    rules = spark.createDataFrame([], "table string, name string, predicate string")
    data = spark.createDataFrame([("keep",), ("drop",)], "action string")
    rules, what = runs.ensure_vocabulary(rules, "journal", "action", ["keep", "drop"], data)
    assert what == "added" and runs.ensure_vocabulary(rules, "journal", "action", ["drop", "keep"], data)[1] == "kept"
    with pytest.raises(ValueError):
        runs.ensure_vocabulary(rules, "journal", "action", ["keep"], data)
    written = spark.createDataFrame([("citation", "work", 3), ("corpus", "pages", 2)], "schema string, table string, rows long")
    kinds = spark.createDataFrame([("our-document", 3)], "kind string, n long")
    stamped = runs.stamp_manifest({"profile": "full"}, written, kinds)
    assert stamped["pages_count"] == 2 and stamped["documents_count"] == 0 and stamped["citation"]["work_count"] == 3 and stamped["citation"]["cites_count"] == 0
    report = runs.markdown_report("R", spark.createDataFrame([("a|b",)], "t string"), ["t"], old="x\n## Notes\nmine")
    assert "a\\|b" in report and report.endswith("## Notes\nmine")


def test_journal_streams(spark, tmp_path):
    from folioscope.streaming import journal

    works = spark.createDataFrame([(1, "a"), (2, "b")], "id long, key string")
    snapshots.publish(works, f"file://{tmp_path}/works")
    snapshots.publish(spark.createDataFrame([], "citing long, cited long, source string"), f"file://{tmp_path}/cites")
    spark.createDataFrame([("a", "b", "s"), ("a", "a", "s"), ("a", "gone", "s")], "citing_key string, cited_key string, source string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("citing_key string, cited_key string, source string").parquet(f"{tmp_path}/in")
    for _ in range(2):
        journal.merge_edges(stream, f"file://{tmp_path}/works", f"file://{tmp_path}/cites", f"{tmp_path}/check").awaitTermination()
    assert [tuple(r) for r in snapshots.read(spark, f"file://{tmp_path}/cites").collect()] == [(1, 2, "s")]
    texts = spark.createDataFrame([(1, "abc"), (2, " "), (3, "d")], "id long, text string")
    got = {r["id"]: list(r["embedding"]) for r in journal.embed_pending(texts, lambda ts: [[float(len(t)), 0.0] for t in ts], 2).collect()}
    assert got == {1: [3.0, 0.0], 3: [1.0, 0.0]}


def test_index_rows_and_identifiers(spark):
    lines = spark.createDataFrame([(1, "| 2009 | `a/b.pdf` | T | x | [url](https://x/1) |"), (2, "| 2010 | `b.pdf` | T | [url](http://y/2) | z |"), (3, "| head |")], "number long, value string")
    assert [tuple(r) for r in text_sources.index_urls(lines).collect()] == [("b", "http://y/2")]


def test_page_split_drops_one_blank(spark):
    docs = spark.createDataFrame([("d", "a\fb\f \n")], "id string, t string")
    assert [r["body"] for r in text_sources.split_pages(docs, "id", F.col("t")).orderBy("page_number").collect()] == ["a", "b"]


def test_snowball(spark, tmp_path):
    unit = lambda i: [1.0 if j == i else 0.0 for j in range(4)]
    rows = [("S", "10.1/s", "seed", 2000, 5, ["R", "Q"], unit(0)), ("C", "", "citer", 2001, 1, ["S"], unit(0)), ("R", "", "ref", 1999, 9, [], unit(0)), ("Q", "", "far", 1998, 1, [], unit(1)), ("D", "", "", 2002, 1, ["C"], unit(0)), ("T", "https://doi.org/10.1/S", "twin", 2003, 2, ["S"], unit(0))]
    records = spark.createDataFrame(rows, "id string, doi string, title string, year int, cited_by_count long, refs array<string>, embedding array<float>")
    ball = crawl.Snowball(records, lambda df, n: spark.createDataFrame(df.collect(), df.schema), tau=0.5, hub_cap=100)
    ball.seed(spark.createDataFrame([("doc", "S"), ("gone", "Z")], "document_id string, id string"))
    assert {r["key"] for r in ball.run(2).collect()} == {"S", "C", "R"}  # T is S again, Q is far, D has no title
    assert {(r["citing"], r["cited"]) for r in ball.edges().collect()} == {("S", "R"), ("C", "S")}
    actions = {(r["action"], r["candidate_key"]) for r in ball.steps().collect()}
    assert {("seed-missing", None), ("keep", "C"), ("drop", "Q"), ("drop", "D")} <= actions


def test_cites_have_the_edges_of_every_line(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    lines, n = pq.read_table(f"{sf}/lineitem.parquet").to_pandas(), 500
    want = {(a, b, c) for a, b, c in zip(lines.l_orderkey % n, lines.l_partkey % n, lines.l_linestatus, strict=True) if a != b}
    got = [tuple(r) for r in standins.load(spark, sf, "cites").select("citing", "cited", "source").collect()]
    assert len(got) == len(want) and set(got) == want


def crawl_by_hand(sf):
    """Nodes by depth of crawl_levels over every lineitem row and seed; every DOI is different."""
    import numpy as np
    import pyarrow.parquet as pq

    e, lines = (pq.read_table(f"{sf}/{t}.parquet").to_pandas() for t in ("embeddings", "lineitem"))
    ids, n = e.vec_id.tolist(), e.vec_id.max() + 1
    edges = {(a, b) for a, b in zip(lines.l_orderkey % n, lines.l_partkey % n, strict=True) if a != b}
    up, down = ({i: set() for i in range(n)} for _ in range(2))
    for a, b in edges:
        up[b].add(a)
        down[a].add(b)
    unit = {i: v / np.linalg.norm(v) for i, v in zip(ids, np.stack(e.embedding.to_numpy()).astype(float), strict=True)}
    seeds = [i for i, label in zip(ids, e.label, strict=True) if label == 0]
    mean = np.mean([unit[i] for i in seeds], axis=0)
    mean /= np.linalg.norm(mean)
    known, frontier, sizes = set(seeds), set(seeds), {0: len(seeds)}
    for depth in (1, 2):
        cites = {a for b in frontier if b % 100 <= 95 for a in up[b]}
        found = {i for i in cites | {b for a in frontier for b in down[a]} if i in unit and i not in known and unit[i] @ mean >= 0.05}
        known |= found
        frontier, sizes[depth] = found, len(found)  # depths 0 and 1 expand whole
    return {k: v for k, v in sizes.items() if v}


def test_crawl_levels_equal_a_crawl_by_hand(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["depth"]: r["nodes"] for r in registry.QUERIES["crawl_levels"](spark, sf).collect()}
    assert got == crawl_by_hand(sf)


def test_topk_plan_has_no_full_sort(spark):
    w = works(spark, (1, "a", graph.SKELETON, None, [1.0, 0.0]))
    plan = graph.nearest(w, [1.0, 0.0], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "CartesianProduct" not in plan


def test_batch_counts_take_the_first_page(spark):
    pages = spark.createDataFrame([("b", "cites:W1", 9), ("a", "cites:W1", 4), ("c", None, None)], "name string, filter string, count long")
    assert [tuple(r) for r in text_sources.batch_counts(pages).collect()] == [("cites:W1", 4), ("", 0)]


def test_page_ids_are_no_years_but_years_in_titles_are(spark, tmp_path):
    import duckdb

    ids = [0, 5, 1899, 1900, 1950, 1995, 1999, 2000, 2099, 2100, 11950, 19501, -1950, -2005]
    spark.createDataFrame([(i,) for i in ids], "page_id long").write.parquet(f"file://{tmp_path}/pages.parquet")
    got = registry.QUERIES["quoted_titles"](spark, f"file://{tmp_path}").collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = db.execute(registry.ORACLE_SQL["quoted_titles"]).fetchall()
    assert len(got) == len(ids) and sorted(tuple(r) for r in got) == sorted(want)
    page = F.lit("<title>\u201cOn 1950\u201d 1989 &ldquo;a_b 19501&rdquo;</title>")
    assert spark.range(1).select(text_sources.quoted_titles(page).alias("t")).first()["t"] == (["On 1950", "a_b 19501"], [1950, 1989])


def test_files_of_other_kinds(spark, tmp_path):
    from folioscope.sources import files

    (tmp_path / "pages").mkdir()
    for name, body in (("a-01.txt", " x \n"), ("a-02.txt", " \n"), ("a-10.txt", "y\nz"), ("notes.txt", "no")):
        (tmp_path / "pages" / name).write_text(body)
    pages = text_sources.transcribed_pages(spark, f"file://{tmp_path}/pages")
    assert sorted(tuple(r) for r in pages.collect()) == [("a", 1, "x"), ("a", 10, "y\nz")]
    docs = files.document_per_file(spark, f"file://{tmp_path}/pages/notes.txt")
    assert [tuple(r) for r in docs.collect()] == [("notes", 1, "no")]
    (tmp_path / "m.json").write_text('{"documents": [{"id": "a", "pages": 2}, {"id": "b"}]}')
    assert sorted((r["id"], r["pages"]) for r in text_sources.manifest_documents(spark, f"file://{tmp_path}/m.json").collect()) == [("a", 2), ("b", None)]
    found = text_sources.blobs(spark, f"file://{tmp_path}/pages/notes.txt").first()
    assert bytes(found["source_blob"]) == b"no" and found["source_sha256"] == hashlib.sha256(b"no").hexdigest()


def test_dry_run_writes_nothing_and_foreign_ids_are_refused(spark):
    assert snapshots.dry_run(spark.range(60))[0] == 60 and len(snapshots.dry_run(spark.range(60))[1]) == 50
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, source_dir string")
    merge.refuse_foreign_ids(old, spark.createDataFrame([(1,), (9,)], "id long"), "a")
    for taken in (2, 3):
        with pytest.raises(ValueError, match="another tree"):
            merge.refuse_foreign_ids(old, spark.createDataFrame([(taken,)], "id long"), "a")


def test_completeness_by_hand(spark):
    columns = "id string, kind string, path string, pages int, sha256 string"
    on_disk = [("a", "include", "d/a", 2, "h"), ("b", "include", "d/b", None, "h"), ("c", "include", "d/c", 1, "h"), ("e", "exclude", "d/e", 1, "h"), ("x", "unclassified", "d/x", 1, "h")]
    documents = [("a", 3, "d/a", "h", "", True), ("b", 0, "d/gone", "h", "u", True), ("e", 1, "d/e", "h", "u", True)]
    got = checks.completeness(
        spark.createDataFrame(on_disk, columns), spark.createDataFrame(documents, "id string, pages_count int, source_path string, source_sha256 string, source_url string, has_blob boolean"),
        spark.createDataFrame([("a",)], "id string"),
    )
    assert sorted(tuple(r) for r in got.collect()) == [("a", "no-url"), ("a", "page-count"), ("b", "broken-path"), ("b", "empty-metadata"), ("c", "not-indexed"), ("d/x", "unclassified"), ("e", "phantom-row")]


def test_declared_embedder(spark):
    from folioscope.operators.embedding import Embedder, EmbedderUnavailable

    def fails(error):
        def call(model, texts):
            raise error
        return call

    models = spark.createDataFrame([("m", 2)], "model string, dims int")
    good = Embedder.declared(models, lambda model, texts: [[float(len(model)), float(len(t))] for t in texts])
    assert good.query("abc") == good.required("abc") == [1.0, 3.0]
    texts = spark.createDataFrame([(1, "ab"), (2, " ")], "id long, text string")
    assert [(r["id"], list(r["embedding"])) for r in good.table(texts).collect()] == [(1, [1.0, 2.0])]
    assert Embedder.declared(models.limit(0), fails(OSError())) is None
    with pytest.raises(ValueError):
        Embedder.declared(models.union(models), fails(OSError()))
    for error in (ConnectionError(), KeyError("embeddings"), IndexError()):
        away = Embedder.declared(models, fails(error))
        assert away.query("abc") is None
        with pytest.raises(EmbedderUnavailable):
            away.required("abc")
    with pytest.raises(ValueError, match="embed the store again"):
        Embedder.declared(models, lambda model, texts: [[1.0]]).query("abc")
    with pytest.raises(Exception, match="doesn't fit"):
        Embedder.declared(models, lambda model, texts: [[1.0, 2.0]] * 3).table(texts).collect()
    pages = spark.createDataFrame([(1, 1, 1, "школа", [1.0, 0.0])], "id long, document_id long, page_number int, body string, embedding array<float>")
    found, notice = retrieval.search(pages, "школа", "hybrid", embed=Embedder.declared(models, fails(OSError())).query)
    assert notice and found.count() == 1


def test_late_journal_rows_count_until_the_watermark(spark, tmp_path):
    from folioscope.streaming import journal

    for i, rows in enumerate(([("2024-01-01 00:10:00", "keep"), ("2024-01-01 03:00:00", "keep")], [("2024-01-01 02:55:00", "keep")], [("2024-01-01 00:20:00", "keep"), ("2024-01-01 09:00:00", "drop")])):
        spark.createDataFrame(rows, "at string, action string").selectExpr("CAST(at AS timestamp) AS at", "action").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("at timestamp, action string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    counts = journal.action_counts(stream)
    counts.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    got = {(str(r["s"]), r["action"]): r["n"] for r in spark.sql("SELECT date_format(window.start, 'HH') s, action, n FROM late").collect()}
    assert got == {("00", "keep"): 1, ("02", "keep"): 1, ("03", "keep"): 1}


def test_manifest_gates_end_at_the_first_failure(spark):
    from folioscope.operators.manifest_gates import manifest_gates

    files = spark.createDataFrame([("d.gz", 5, "s"), ("other", 9, "s")], "name string, bytes long, sha256 string")
    good = {
        "schema_version": 3, "profile": "public", "citation": {}, "dump": {"file": "d.gz", "bytes": 5, "sha256": "s"},
        "legal": {"shipped_distributions": ["full-text"], "full_content_distributions": ["full-text", "internal"]},
    }
    names = ["version", "profile", "vocabulary", "citation", "dump", "dump-intact"]
    assert [(n, ok) for n, ok, _ in manifest_gates(good, files, 3)] == [(n, True) for n in names]
    lists = good["legal"]
    faults = [
        ("version", {"schema_version": 2}), ("profile", {"profile": None}), ("vocabulary", {"legal": {**lists, "shipped_distributions": []}}),
        ("vocabulary", {"legal": {**lists, "shipped_distributions": ["excluded"]}}), ("vocabulary", {"legal": {**lists, "full_content_distributions": ["metadata-only"]}}),
        ("vocabulary", {"legal": []}), ("citation", {"citation": "none"}), ("dump", {"dump": ["d.gz"]}), ("dump", {"dump": {"file": 1}}),
        ("dump-intact", {"dump": {"file": "gone"}}), ("dump-intact", {"dump": {"file": "d.gz", "bytes": 4, "sha256": "s"}}), ("dump-intact", {"dump": {"file": "d.gz", "bytes": 5, "sha256": "z"}}),
    ]
    for gate, change in faults:
        got = manifest_gates(good | change, files, 3)
        assert [n for n, _, _ in got] == names[: names.index(gate) + 1] and [ok for _, ok, _ in got] == [True] * (len(got) - 1) + [False] and got[-1][2]
    full = good | {"profile": "full", "legal": {**lists, "shipped_distributions": ["excluded"]}}
    assert all(ok for _, ok, _ in manifest_gates(full, files, 3))


def test_journal_steps_have_known_actions(spark):
    rows = spark.createDataFrame([("a", -1.0), ("b", 0.1)], "k string, score double")
    got = crawl.step(rows, "drop", 2, candidate_key=F.col("k"), reason=crawl.drop_reason(F.col("score")))
    assert sorted(tuple(r) for r in got.collect()) == [(2, "drop", "a", "no text to embed"), (2, "drop", "b", "below-threshold")]
    with pytest.raises(ValueError, match="unknown action"):
        crawl.step(rows, "dropped", 2)

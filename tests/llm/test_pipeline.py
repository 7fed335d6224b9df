import corpus_pipeline
from folioscope.llm import queries


def test_stages_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "substring", "mixing", "bpe"]
    now, seen = docs, []
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(step(spark, now, sf).collect(), docs.schema)
        seen.append(now.count())
        assert now.columns == docs.columns
    assert docs.count() >= seen[0] >= seen[1] == seen[2] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert out.count() == seen[3] and out.filter("n_tokens < 0 OR ids IS NULL").count() == 0


def pipeline_by_hand(rows, bad):
    """(doc_id, ids) of every document of the mix; rows: (doc_id, text, lang, source, n_chars)."""
    from collections import Counter

    import duckdb
    import pandas as pd
    from test_llm import WORD, brute_windows
    from tokenizers import Tokenizer

    rows = [r for r in rows if not bad & set(WORD.findall(r[1]))]
    held = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (WORD.findall(r[1]) for r in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (held[i] & held[j]).total() >= 0.8 * (held[i] | held[j]).total():
                label = [label[j] if x == label[i] else x for x in label]
    rows = [min(r for r, x in zip(rows, label, strict=True) if x == k) for k in sorted(set(label))]
    cut = brute_windows([r[1] for r in rows], 35)
    texts = {r[0]: kept if gone else r[1] for r, (_, gone, kept) in zip(rows, cut, strict=True)}
    documents = pd.DataFrame([(r[0], texts[r[0]], r[3]) for r in rows], columns=["doc_id", "text", "source"])  # noqa: F841
    taken = duckdb.sql(queries.ORACLE_SQL["op4_source_mix"]).df()
    lib = Tokenizer.from_file(queries.tokenizer_path())
    copies = {i: n // size for i, size, n in zip(taken.doc_id, taken["size"], taken.taken, strict=True)}
    return sorted((i, tuple(lib.encode(t, add_special_tokens=False).ids)) for i, t in texts.items() for _ in range(copies[i])), len(rows), sum(gone > 0 for _, gone, _ in cut)


def test_run_equals_the_stages_by_hand(spark, tmp_path):
    import numpy as np
    from test_llm import DOCS, prose

    bad = {"vilest", "scumbag", "filthrat"}
    texts = [prose(100 + i % 9, i, 3000) for i in range(160)]
    texts = [f"{t} {' '.join(bad)} {' '.join(bad)}" if i % 4 == 1 else t for i, t in enumerate(texts)]
    texts += [t + f" tail{i}" for i, t in enumerate(texts[:40])]  # near copies, toxic ones among them
    passage = prose(45, 999, 3000)
    texts += [f"{prose(70, 500 + i, 3000)}\n{passage}  {prose(60, 600 + i, 3000)}" for i in range(6)]
    rows = [(i, t, "en", "abc"[min(i % 7, 2)], len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1, int(bool(bad & set(r[1].split())))) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want, kept, cut = pipeline_by_hand(rows, bad)
    assert (kept, cut) == (126, 6) and len(want) > 0
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert sorted((r["doc_id"], tuple(np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist())) for r in got) == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got)


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows, one very long text, clashing names and no rows
    at all: toxicity, near copies, passages and mix keep the columns and clean rows."""
    from pyspark.sql import functions as F
    from test_llm import DOCS, prose

    long = prose(30_000, 3, 20_000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, prose(50, 1), "en", "a", 9), (4, long, "en", "b", len(long)), (5, prose(60, 2), "en", "b", 9)]
    extra = {c: F.lit(-7) for c in ("n_removed", "n_words", "kept_text", "class_id", "kept", "score", "copies", "size", "target", "_n", "key", "part", "_spans")}
    docs = spark.createDataFrame(rows, DOCS).withColumns(extra)
    sf = "/root/testdata/sf0.001"
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[c] == -7 for r in got for c in extra), name
        assert out.schema == docs.schema or name != "toxicity"
        texts = [r["text"] for r in got]
        assert long in texts and len(got) >= (3 if name == "mixing" else len(rows)), name
        assert step(spark, docs.limit(0), sf).count() == 0
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert ids.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded_sha256"] and ids.count() == len(rows)

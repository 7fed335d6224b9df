import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import bpe, chat, components, embed_dedup, labelled, minhash, mixing, quality, sharding, substring, topk, toxicity
from folioscope.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a", "b", None])[i % len(sources or "abc")], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


ODD = [None, "", " \n\t ", "one", "é ü  x", "same text", "same text", "x " * 3000, "<|endoftext|> end<|endoftext|>"]


def test_shards_are_contiguous_and_even(spark):
    texts = [*ODD, *(prose(20 + i % 7, i) for i in range(300)), *["copy " * 12] * 100]
    rows = sharding.shard_by_bytes(docs(spark, texts).withColumn("_g", F.lit(1)).withColumn("size", F.lit("clash")), 8).toPandas()
    want = {i: len((t or "").encode()) + 8 for i, t in enumerate(texts)}
    assert dict(zip(rows.doc_id, rows["size"], strict=True)) == want
    by = rows.groupby("shard").agg(total=("size", "sum"), n=("slot", "count"), top=("slot", "max"))
    assert set(by.index) == set(range(8)) and (by.n - 1 == by.top).all()
    assert by.total.max() - by.total.min() <= 2 * max(want.values())
    import zlib

    assert all(c == zlib.crc32((texts[i] or "").encode()) for i, c in zip(rows.doc_id, rows.text_crc32, strict=True))
    assert sharding.shard_by_bytes(docs(spark, ["a"]).limit(0), 8).count() == 0


def shards_by_hand(rows, shards, share):
    """(doc_id -> shard) over rows (doc_id, text), in plain Python."""
    import xxhash

    def spark_hash(value, seed):
        return seed if value is None else xxhash.xxh64(value, seed=seed).intdigest()

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    size = [len((t or "").encode()) + 8 for _, t in rows]
    group = [signed(spark_hash(b"text", spark_hash(None if t is None else t.encode(), 42))) for _, t in rows]
    tie = [signed(spark_hash(i.to_bytes(8, "little", signed=True), 42)) for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (group[i], tie[i]))
    at = dict(zip(order, np.concatenate([[0], np.cumsum([size[i] for i in order])]).tolist(), strict=False))
    target = sum(size) / shards
    cuts = []
    for k in range(1, shards):
        i = next(i for i in order if at[i] < k * target <= at[i] + size[i])
        same = [j for j in order if group[j] == group[i]]
        low, high = min(at[j] for j in same), max(at[j] + size[j] for j in same)
        if high - low > share * target:
            low, high = at[i], at[i] + size[i]
        cuts.append(low if k * target - low <= high - k * target else high)
    return {rows[i][0]: sum(c <= at[i] for c in cuts) for i in order}


@pytest.mark.parametrize("share", [0.0, 0.3])
def test_shards_equal_cuts_by_hand(spark, share):
    texts = [None, None, "", *(prose(20 + i % 7, i) for i in range(150)), *["copy " * 12] * 30, *["second copy " * 9] * 5]
    got = sharding.shard_by_bytes(docs(spark, texts), 6, group_share=share).toPandas()
    assert dict(zip(got.doc_id, got.shard, strict=True)) == shards_by_hand(list(enumerate(texts)), 6, share)
    whole = got[got.doc_id >= len(texts) - 5]
    assert share == 0 or whole.shard.nunique() == 1


def test_shards_of_repeated_and_empty_rows(spark):
    table = docs(spark, ["same"] * 12 + [None] * 12).withColumn("doc_id", F.lit(1).cast("long"))
    got = sharding.shard_by_bytes(table, 4).toPandas()
    assert len(got) == 24 and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    blank = sharding.shard_by_bytes(docs(spark, [None] * 5), 2).toPandas()
    assert (blank["size"] == 8).all() and (blank.text_crc32 == 0).all()


def test_mix_meets_targets_and_repeats(spark):
    texts = [*ODD, *(prose(10 + i % 50, i) for i in range(600))]
    table = docs(spark, texts, ["a"] * 12 + ["b", "c", None])
    a, b = (mixing.mix(table).toPandas().sort_values("doc_id").reset_index(drop=True) for _ in range(2))
    assert a.equals(b) and (a.copies <= 3).all()
    a["taken"] = a["size"] * a.copies
    g = a.groupby(a.source.fillna("~")).agg(t=("target", "first"), k=("taken", "sum"), s=("source_size", "first"))
    assert (abs(g.k - g.t) <= 0.02 * g.t).all() and (g.t <= 3 * g.s + 1e-6).all()  # one document is 15% of its source
    assert g.t.sum() == pytest.approx(g.s.sum())
    assert a["size"].tolist() == [len(WORD.findall(t or "")) for t in texts]
    assert mixing.mix(table.limit(0)).count() == 0
    assert mixing.mixed_documents(table).columns == table.columns


def test_mix_of_repeated_rows_and_ids(spark):
    texts = [prose(5 + i % 40, i) for i in range(300)]
    table = docs(spark, texts, ["a", "a", "a", "b"]).withColumns({"doc_id": F.when(F.col("doc_id") < 290, F.col("doc_id") % 150), "copies": F.lit("clash")})
    table = table.union(table.orderBy("n_chars", "text").limit(3))
    mixed = mixing.mix(table).toPandas()
    written = mixing.mixed_documents(table).toPandas()
    assert len(mixed) == 303 and written.columns.tolist() == table.columns and (written.copies == "clash").all()
    assert sum(len(WORD.findall(t)) for t in written.text) == (mixed["size"] * mixed.copies).sum()
    by = mixed.groupby("source").agg(t=("target", "first"), k=("copies", lambda c: (c * mixed.loc[c.index, "size"]).sum()))
    assert (abs(by.k - by.t) <= 45).all()


def test_mix_draws_with_unequal_probabilities(spark):
    """Realised inclusion over many seeds follows each document's expected copies."""
    sizes = [5, 20, 300, 900, 2500] * 30
    table = docs(spark, [prose(n, i) for i, n in enumerate(sizes)], ["a"] * 149 + ["b"]).withColumn("stars", (F.col("doc_id") % 5) + 1).cache()
    for emphasis, worth in ((None, [9000 + min(n, 1000) for n in sizes]), ("stars", [1000 * (i % 5 + 1) for i in range(150)])):
        runs = [mixing.mix(table, weights=(1, 4), seed=f"s{k}", emphasis=emphasis).toPandas().set_index("doc_id") for k in range(6)]
        a = runs[0][runs[0].source == "a"]
        low, high = 0.0, 1.0
        for _ in range(100):  # by bisection: the scale at which expected words meet the target
            c = (low + high) / 2
            low, high = (c, high) if sum(min(3, c * worth[i]) * sizes[i] for i in a.index) < a.target.iloc[0] else (low, c)
        want = {i: min(3, low * worth[i]) for i in a.index}
        got = {i: np.mean([r.copies[i] for r in runs]) for i in a.index}
        for kind in range(5):
            some = [i for i in a.index if i % 5 == kind]
            assert np.mean([got[i] for i in some]) == pytest.approx(np.mean([want[i] for i in some]), abs=0.15)
        assert len({round(x, 6) for x in want.values()}) > 3


def brute_windows(texts, k):
    words = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if count[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((len(w), sum(gone), " ".join(x for x, y in zip(w, gone, strict=True) if not y)))
    return out


@pytest.mark.parametrize("k", [6, 35])
def test_substring_equals_brute_force(spark, k):
    passage = prose(k + 10, 99)
    texts = [*ODD, *(prose(60, i) for i in range(20)), *(f"{prose(30, 100 + i)}\n{passage}  {prose(9, 200 + i)}" for i in range(8)), prose(k, 5), prose(k, 5), "a b " * 50, prose(80, 3)[:-3]]
    got = substring.remove_repeated(docs(spark, texts).withColumn("_spans", F.lit(1)).withColumn("_key", F.lit("k")), k, gram=3, flush=2000, part_bytes=500).toPandas().sort_values("doc_id")
    assert list(zip(got.n_words, got.n_removed, got.kept_text, strict=True)) == brute_windows(texts, k)
    assert substring.remove_repeated(docs(spark, ["a"]).limit(0), k).count() == 0


def test_substring_splits_a_hot_passage(spark):
    """A passage in most documents: its buckets are split, and parts hold a bounded share."""
    passage = prose(60, 99)
    texts = [f"{prose(40, 300 + i)} {passage} {prose(40, 700 + i)}" for i in range(150)] + [prose(3000, 5)] + [prose(50, i) for i in range(20)]
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = substring.remove_repeated(docs(spark, texts).withColumn("n_removed", F.lit(-7)), 35, part_bytes=9000, buckets_per_partition=1).toPandas().sort_values("doc_id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert list(zip(got.n_words, got.n_removed, got.kept_text, strict=True)) == brute_windows(texts, 35)


def test_substring_by_parts_equals_all_at_once():
    texts = [prose(40, i, 6) for i in range(30)] + [prose(40, 1, 6)] * 5
    packed = [substring.Words(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t.encode())])).joined()[0] for t in texts]
    meta = np.zeros(len(texts), dtype=substring.META)
    meta["lo"], meta["copies"], meta["bytes"] = range(len(texts)), 1, [len(p) for p in packed]
    meta["copies"][3] = 2
    whole = substring.repeated_windows(meta, np.concatenate(packed), 4)
    import zstandard

    blobs = []
    for i in range(0, len(texts), 7):
        head = b"".join(np.ascontiguousarray(meta[i : i + 7][c]).tobytes() for c in substring.META.names)
        blobs.append(len(meta[i : i + 7]).to_bytes(8, "little") + zstandard.ZstdCompressor().compress(head + np.concatenate(packed[i : i + 7]).tobytes()))

    def covered(spans):
        return {(s["lo"], w) for s in spans for w in range(s["start"], s["end"])}

    parts = list(substring.repeated_by_parts(blobs, 4, 5))
    assert len(parts) > 1 and covered(np.concatenate(parts)) == covered(whole)
    with pytest.raises(substring.Collision):
        list(substring.repeated_by_parts(blobs, 4, 2, hashed=lambda h, n: np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)))


def test_substring_survives_hash_collisions():
    from folioscope.llm.words import Words

    texts = [prose(20, i, 5) for i in range(6)] + [prose(20, 1, 5)]
    packed = [Words(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t.encode())])).joined()[0] for t in texts]
    meta = np.zeros(len(texts), dtype=substring.META)
    meta["lo"], meta["copies"], meta["bytes"] = range(len(texts)), 1, [len(p) for p in packed]
    spans = substring.repeated_windows(meta, np.concatenate(packed), 5, hashed=lambda h, n: np.zeros(max(0, len(h) - n + 1), dtype=np.uint64))
    gone = collections.defaultdict(set)
    for s in spans:
        gone[s["lo"]] |= set(range(s["start"], s["end"]))
    assert [len(gone[i]) for i in range(len(texts))] == [x[1] for x in brute_windows(texts, 5)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    lib = Tokenizer.from_file(path)
    r = random.Random(4)
    wild = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x800), r.randrange(0x3000, 0xD000), r.randrange(0x10000, 0x20000), 10, 32, 0x1C, 0x85])) for _ in range(60)) for _ in range(60)]
    texts = [*ODD, *wild, "don't  stop\n\n now ՘a 　b", "<|endoftext|>", prose(300, 1)]
    coded = bpe.decode(bpe.encode(docs(spark, texts).withColumn("blob", F.lit("clash")), path, block_bytes=700), path).toPandas().sort_values("doc_id")
    for text, ids, back in zip(texts, coded.ids, coded.decoded, strict=True):
        want = lib.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(ids), dtype="<u4").tolist() == want
        assert back == lib.decode(want, skip_special_tokens=False)
    assert (coded.blob == "clash").all()
    assert bpe.encode(docs(spark, ["a"]).limit(0), path).count() == 0
    odd = spark.createDataFrame([(np.array([196, 300, 50256], dtype="<u4").tobytes(),), (None,)], "ids binary")
    assert [x["decoded"] for x in bpe.decode(odd, path).collect()] == [lib.decode([196, 300, 50256], skip_special_tokens=False), ""]


def test_bpe_of_rows_dealt_at_random_and_long_texts(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    lib = Tokenizer.from_file(path)
    texts = [*(prose(30, i) for i in range(200)), prose(200_000, 7, 50_000), *["same again"] * 9]
    table = docs(spark, texts).withColumn("doc_id", F.col("doc_id") % 180).repartition(7)  # dealt by round robin; ids repeat
    got = bpe.decode(bpe.encode(table, path), path).collect()
    want = sorted((i % 180, t, lib.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts))
    assert sorted((r["doc_id"], r["text"], np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()) for r in got) == want
    assert all(r["decoded"] == r["text"] for r in got)


def test_near_duplicates_equal_brute_force(spark):
    base = [prose(120, i, 5000) for i in range(30)]
    near = [re.sub(r"^\S+ \S+", "new start", t) for t in base[:10]]
    far = [" ".join(t.split()[:60]) + " " + prose(60, 500 + i, 5000) for i, t in enumerate(base[:10])]
    hot = [f"{base[29]} tail{i}" for i in range(60)]
    texts = [*base, *near, *far, *base[:5], *hot, None, "", " ", "two words", "two words"]
    got = minhash.near_duplicates(docs(spark, texts).withColumn("key", F.lit("clash"))).toPandas().set_index("doc_id")
    cls = got.class_id.to_dict()
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := WORD.findall(t or "")) else set() for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            s = len(sets[i] & sets[j]) / union if union else 0
            if s >= 0.82:
                assert cls[i] == cls[j], (i, j, s)
            elif s < 0.5:
                assert cls[i] != cls[j] or s > 0.3, (i, j, s)
    assert got.kept.sum() == got.class_id.nunique()
    n = len(texts)
    assert all(cls[i] == i for i in (n - 5, n - 4, n - 3)) and cls[n - 1] == n - 2
    assert minhash.near_duplicates(docs(spark, ["a"]).limit(0)).count() == 0


def weighted_bags(texts):
    """Shingles with tf * (1 + ln(N / df)), df counted over representatives, in plain Python."""
    held = [collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := WORD.findall(t or "")) else {} for t in texts]
    key = [hashlib.md5((t or "").encode()).hexdigest() for t in texts]
    bands = {}
    for t, k in zip(texts, key, strict=True):
        data = np.frombuffer((t or "").encode(), dtype=np.uint8)
        doc, value, _ = minhash.shingles(data, np.array([0, len(data)]), 5)
        bands[k] = minhash.plain_bands(doc, value)[1].ravel().tolist()
    least = {}
    for k, b in bands.items():
        for at in enumerate(b):
            least[at] = min(least.get(at, k), k)
    stands = {k for k, b in bands.items() if b and all(least[at] == k for at in enumerate(b))}
    df = collections.Counter(x for k, h in dict(zip(key, held, strict=True)).items() if k in stands for x in h)
    return [{x: n * (1 + np.log(len(stands) / max(1, df[x]))) for x, n in h.items()} for h in held]


@pytest.mark.parametrize("block", [4096, 12])
def test_near_duplicates_in_a_hot_group_equal_brute_force(spark, block):
    """Copies with edits of their own: many pairs fall short, so a class holds together by some links only."""
    r = random.Random(8)
    base = prose(90, 77, 5000).split()
    texts = [prose(60, i, 5000) for i in range(20)]
    for _ in range(90):
        words = list(base)
        for _ in range(r.randrange(0, 4)):
            words[r.randrange(len(words))] = f"w{r.random()}"
        texts.append(" ".join(words))
    bags = weighted_bags(texts)
    label = list(range(len(texts)))
    short = 0
    for i in range(len(texts)):
        for j in range(i):
            low = sum(min(w, bags[j].get(v, 0)) for v, w in bags[i].items())
            s = low / (sum(bags[i].values()) + sum(bags[j].values()) - low)
            short += 0.5 < s < 0.8
            if s >= 0.8 and label[i] != label[j]:
                a, b = max(label[i], label[j]), min(label[i], label[j])
                label = [b if x == a else x for x in label]
    got = minhash.near_duplicates(docs(spark, texts), block=block).toPandas().set_index("doc_id").class_id.to_dict()
    assert short > 500 and got == dict(enumerate(label))


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    value = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    a, b = rng.uniform(0.3, 3, 400), rng.uniform(0.3, 3, 400)
    _, x = minhash.samples(np.zeros(400, dtype=np.int64), value, a, 600)
    _, y = minhash.samples(np.zeros(400, dtype=np.int64), value, b, 600)
    assert (x == y).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.07)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    close = base[:60] + rng.normal(scale=0.02, size=(60, 16))
    v = np.concatenate([base, close, base[:3], np.repeat(base[5:6], 40, 0) + rng.normal(scale=0.01, size=(40, 16))]).astype(np.float32)
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, []), (1004, [1.0, 2.0])]
    table = vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)] + odd).withColumn("rep", F.lit("clash"))
    got = embed_dedup.link_vectors(table.union(table.limit(1)), block=16, prefix=8).toPandas()
    assert len(got) == len(v) + len(odd) + 1
    got = got.drop_duplicates().set_index("vec_id")
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    n = got.n_links.reindex(range(len(v))).to_numpy()
    assert (n <= links.sum(1)).all() and n.sum() >= 0.97 * links.sum()
    label = np.arange(len(u))
    for _ in range(len(u)):
        label = np.minimum(label, np.where(links, label[None], len(u)).min(1))
    assert (got.component_id.reindex(range(len(v))).to_numpy() == label).mean() >= 0.95
    assert all(got.n_links[i] == 0 and got.kept[i] for i, _ in odd)
    assert embed_dedup.link_vectors(table.limit(0)).count() == 0


def test_embedding_links_of_a_group_of_a_third(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(6000, 64))
    v[:2000] = rng.normal(size=64) + rng.normal(scale=0.14, size=(2000, 64))  # cosines of about 0.98
    v = v.astype(np.float32)
    got = embed_dedup.link_vectors(vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)]), block=512, min_pivots=2048).toPandas().set_index("vec_id").sort_index()
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(1) - 1
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.9 * links.sum()
    assert (got.component_id[:2000] == 0).all()


def test_embedding_links_at_every_length(spark):
    rng = np.random.default_rng(4)
    pairs = [np.repeat(rng.normal(size=(n, width)), 2, 0) for n, width in ((60, 16), (9, 7), (1, 5))]
    v = [(x + rng.normal(scale=0.001, size=len(x))).tolist() for p in pairs for x in p] + [[1.0, 2.0, 3.0]]
    got = embed_dedup.link_vectors(vectors(spark, list(enumerate(v)))).toPandas().set_index("vec_id").sort_index()
    assert got.n_links.tolist() == [1] * 140 + [0]
    assert got.component_id.tolist() == [i - i % 2 for i in range(140)] + [140]
    alone = embed_dedup.link_vectors(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in alone) == [(1, 0, 1), (2, 0, 2)]


def test_embedding_links_of_long_vectors_and_shared_ids(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(12, 3000))
    rows = [(i % 10, x.tolist()) for i, x in enumerate(np.concatenate([v[:6], v[:6] * 3 + 1e-4]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embed_dedup.link_vectors(table).drop_duplicates().collect()}
    assert len(got) == 10 and got[6]["n_links"] == 1 and got[6]["component_id"] == 0
    assert got[0]["n_links"] == 1 and got[0]["component_id"] == 0  # 0 is v[0] and v[4] again


def test_top_k_with_ties(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-2, 3, size=(200, 6)) / 64
    table = vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)] + [(500, None), (501, [float("inf")] * 6), (5, v[5].tolist())])
    rows = table.filter(topk.usable(F.col("embedding"))).select("vec_id", topk.floor_scaled(F.col("embedding")).alias("v"))
    got = topk.search_top_k(rows.filter("vec_id % 20 = 0"), rows, 7, block=30, batch=3).toPandas()
    whole = np.floor(v.astype(np.float32).astype(np.float64) * 64).astype(int)
    for q in range(0, 200, 20):
        s = whole @ whole[q]
        want = [i for i in np.lexsort((np.arange(200), -s)) if i != q][:7]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == want and mine.score.tolist() == s[want].tolist()
    assert topk.search_top_k(rows.filter("vec_id = 0"), rows.filter("vec_id < 3"), 7).count() == 2


def test_threshold_stops_by_its_bound_where_few_components_count():
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.exponential(1000, size=(5000, 2)), rng.integers(0, 20, size=(5000, 10))], axis=1).astype(np.int64)
    block = topk.Block(np.arange(5000), v)
    asked = np.concatenate([v[:50], -v[50:60], np.zeros((1, 12), dtype=np.int64)])
    query, at, score, met = topk.threshold_search(block, np.arange(-61, 0), asked, 10)
    assert (met[:50] < 2500).all() and np.median(met[:50]) < 1000 and met[60] == 5000
    for q in range(61):
        s = v @ asked[q]
        want = np.lexsort((np.arange(5000), -s))[:10]
        mine = np.lexsort((at[query == q], -score[query == q]))
        assert at[query == q][mine].tolist() == want.tolist() and score[query == q][mine].tolist() == s[want].tolist()


def test_top_k_of_odd_tables(spark):
    rows = spark.createDataFrame([(0, [3, 1]), (1, [2]), (2, [2, 0, 5]), (2, [1, 1]), (3, []), (3, [])], "vec_id long, v array<long>").withColumn("score", F.lit("clash"))
    got = topk.search_top_k(rows.filter("vec_id IN (0, 3)"), rows, 3, block=2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 6), (0, 2, 2, 6), (0, 3, 2, 4), (3, 1, 0, 0), (3, 2, 1, 0), (3, 3, 2, 0)]
    assert topk.search_top_k(rows.limit(0), rows).count() == topk.search_top_k(rows, rows.limit(0)).count() == 0


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|x|>", "<\\\\|", None, "", "é\n"]
    for t in nasty:
        assert chat.unescape(chat.escape(t or "")) == (t or "") and "<|" not in chat.escape(t or "")
    turns = [(c, i, r, nasty[(c + i) % 6]) for c in range(6) for i, r in enumerate(["user", "assistant"])] + [(7, 0, "assistant", "first"), (7, 1, None, "x"), (8, 0, "user", "u"), (8, 0, "user", "u"), (None, 0, "odd\nrole<|", "n")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    segments = chat.format_conversations(table)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    for c in {t[0] for t in turns}:
        mine = [(r or "", t or "") for k, _, r, t in turns if k == c]
        assert got[c]["n_turns"] == len(mine)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        loss = "".join(t for r, t in mine if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[0]["valid"] and not got[7]["valid"] and not got[8]["valid"]
    one = {r["conv_id"]: r for r in chat.training_texts(segments).collect()}[0]
    assert [one["text"][s["start"] : s["end"]] for s in one["loss_spans"]] == [chat.escape(nasty[1])]
    assert len(one["text"]) == got[0]["formatted_chars"]
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(links.limit(0)).count() == 0


def test_classifiers_on_held_out_documents(spark):
    r = random.Random(5)
    good = [prose(r.randrange(20, 120), i) for i in range(200)]
    junk = [" ".join(f"{w}{r.choice(['%%%', '***', '###'])}" for w in prose(40, 900 + i).split()) for i in range(60)]
    texts = [*good, *junk, None, ""]
    rude = {i for i in range(0, 200, 4)}
    texts = [f"{t} you zorgel, zorgelish {r.choice(['idiot', 'ID10T', 'іdiot'])} here" if i in rude else t for i, t in enumerate(texts)]
    table = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 200), int(i in rude)) for i in range(260)] + [(0, 1, 0), (0, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    q = quality.score(table, quality.fit(table, labels, epochs=8)).toPandas().set_index("doc_id")
    held = [i for i in q.index if q.held_out[i] and i < 260]
    assert len(held) > 20 and np.mean([(q.score[i] >= 0.3) == (i < 200) for i in held]) >= 0.95
    model = toxicity.fit(table, labels)
    t = toxicity.score(table, model).toPandas().set_index("doc_id")
    assert np.mean([(t.score[i] >= 0.5) == (i in rude) for i in held]) >= 0.95
    assert q.score.between(0, 1).all() and t.score.between(0, 1).all() and len(t) == len(texts)
    kept = toxicity.filter_toxic(table, model)
    assert kept.columns == table.columns and kept.count() == (t.score < 0.5).sum()
    assert quality.score(table.limit(0), quality.fit(table, labels.limit(0))).count() == 0
    assert toxicity.score(table.limit(1), toxicity.fit(table, labels.limit(0))).count() == 1


def test_scores_equal_a_plain_version_of_the_models(spark):
    """Scoring by loops over words and characters, given the model."""
    import math

    from folioscope.llm.words import mix

    texts = [*ODD, "Знак ü: you 1d1ot, trash can", "a a a b", "日本語 idiot idiotic", prose(30, 3), prose(3000, 4), "x" * 20_000]
    table = docs(spark, texts).withColumns({"score": F.lit("clash"), "held_out": F.lit(9)})
    rng = np.random.default_rng(2)
    folded, bias = rng.normal(size=1 << 10).astype(np.float32), 0.25
    got = {r["doc_id"]: r["score"] for r in quality.score(table, (folded, bias)).collect()}
    whole, P, Q, R = (1 << 64) - 1, 0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
    for i, text in enumerate(texts):
        text, ids = text or "", []
        words = WORD.findall(text)
        hashes = [int(mix(np.array([sum((b + 1) * pow(P, k, 1 << 64) for k, b in enumerate(w.encode())) & whole], dtype=np.uint64))[0]) for w in words]
        ids += [h >> 54 for h in hashes]
        ids += [0 if a == b else (((a * 31 + b) * Q) & whole) >> 54 for a, b in zip(hashes, hashes[1:], strict=False)]
        code = [0, *(0 if c in " \t\n\v\f\r" else int.from_bytes(c.encode(), "big") for c in text), 0]
        for n in (3, 4, 5):
            for k in range(len(code) - n + 1):
                gram = code[k : k + n]
                if words and all(gram[1:-1]):
                    rolled = gram[0]
                    for c in gram[1:]:
                        rolled = (rolled * Q + c) & whole
                    ids.append((((rolled + n) * R) & whole) >> 54)
        mean = sum(float(folded[x]) for x in ids) / max(1, len(ids))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-mean - bias)), abs=1e-9), text[:20]
    lexicon = [(" idiot ", 2.0), (" idio", 1.5), (" trash ", 1.0)]
    model = {"lexicon": lexicon, "slope": 2.0, "intercept": -1.0}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    for i, text in enumerate(texts):
        folded_text = toxicity.fold_text(text or "")
        excused = [(m.start(), m.end()) for p in toxicity.EXCEPTIONS for m in re.finditer(f"(?= {p} )", folded_text) for m in [re.compile(f" {p} ").match(folded_text, m.start())]]
        total = 0.0
        for k, c in enumerate(folded_text):
            if c == " " and not any(a <= k < b - 1 for a, b in excused):
                total += max([w for e, w in lexicon if folded_text.startswith(e, k)], default=0.0)
        x = math.log1p(10 * total / math.sqrt(len((text or "").split()) + toxicity.SMOOTH))
        assert got[i] == pytest.approx(1 / (1 + math.exp(1 - 2 * x)), abs=1e-9), text
    assert {r["doc_id"] for r in quality.score(docs(spark, ["a", "a"]).withColumn("doc_id", F.lit(None).cast("long")), (folded, bias)).collect()} == {None}


def test_lexicon_matching():
    match = toxicity.Matcher([(" idiot ", 2.0), (" trash ", 1.0), (" lowe", 3.0)])
    assert match.raw("An IDIOT!")[0] == 2 and match.raw("1d1ot")[0] == 2 and match.raw("іdіot")[0] == 2
    assert match.raw("the trash can is full")[0] == 0 and match.raw("trash talk")[0] == 1
    assert match.raw("loweiß flower")[0] == 3 and match.raw(" \n")[0] == 0


def test_training_sample_keeps_fold_out(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    table = docs(spark, [f"t{i}" for i in range(100)])
    got = {r["text"] for r in labelled.training_sample(table, labels, "quality", 1000).collect()}
    import zlib

    assert got == {f"t{i}" for i in range(100) if zlib.crc32(str(i).encode()) % 5}
    assert labelled.training_sample(table, labels, "quality", 10).count() == 10

"""Near-duplicate documents by improved consistent weighted sampling (Ioffe, 2010).

Features are shingles of ``shingle`` words (a shorter text is one shingle of all its
words), weighted by term frequency times inverse document frequency.  For each of
bands * rows hash functions a document samples one shingle, so that two documents
agree with the probability of their weighted Jaccard similarity.  The samples of a
band form a bucket; documents that share a bucket are candidates, and candidates are
verified by their exact weighted Jaccard similarity over whole texts.

Equal texts are one node from the start: tasks send a text once, texts are dealt by a
hash of their digest into ``parts`` and written as a table bucketed by part, which every
later step reads without moving the texts again.

Inverse document frequency is 1 + ln(N / df) for every shingle.  N and df count
representatives: a text that shares one of ``PLAIN`` min-hash bands (of two unweighted
samples each) with a text of smaller digest stands for nothing new, so that a large group
of near copies doesn't make its own shingles common.  A shingle that no representative
holds has df 1.  Counting is exact: each part sends its distinct shingles, with the
number of its representatives that hold them, to the bucket of the shingle's hash; the
bucket adds up and answers each part with the shingles of df over 1, so that no count
leaves out or guesses anything, and no table of shingles is held or broadcast whole.

Texts joined by shared buckets form rooms (``components`` of stars, a table with one row
per text and band), so each text travels once, to the one room that holds all its
candidates.  Small rooms share a bin; a room over ``block`` texts or ``block_bytes`` is
divided by a hash, and every pair of its blocks is a group of its own, so no task holds a
whole hot room.  In a group every pair that shares a bucket is verified unless links
already found there join the two, which leaves the classes those of all verified pairs.
Groups send back a spanning forest of their links; links are joined to classes by
``components``.

Defined results: null, empty and blank texts have no shingles and link with nothing;
equal texts of one or more words are always one class; repeated rows are copies; an
empty table gives no rows; a very long text is a node like any other; only doc_id is
carried.  A null doc_id takes part, but is never the name of a class that has another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.components import components
from folioscope.llm.scratch import alone, give_back, lean, settle, shuffle_partitions, small_batches, stage, stage_by
from folioscope.llm.words import Words, mix, ragged, sorted_groups, text_chunks, window_hash

PLAIN = 4  # unweighted min-hash bands that tell representatives
HEAVY = np.dtype([("h", "<u8"), ("idf", "<f8")])
_LOG = -np.log((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
_UNIT = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle hash) with the number of times it occurs, in order of
    row and then hash."""
    words = Words(data, offsets)
    h = words.hashes()
    n = len(words) - size + 1
    if n > 0:
        whole = words.doc[:n] == words.doc[size - 1 :]
        doc, value = words.doc[:n][whole], window_hash(h, size)[whole]
    else:
        doc, value = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        total = [mix(np.array([sum(int(x) * 31**k for k, x in enumerate(h[words.first[d] : words.first[d + 1]])) % (1 << 64)], dtype=np.uint64))[0] for d in short]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(total, dtype=np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def idf_of(value: np.ndarray, known: tuple[np.ndarray, np.ndarray], most: float) -> np.ndarray:
    """idf of each shingle; ``known``: sorted hashes and idf of those whose idf isn't ``most``."""
    out = np.full(len(value), most)
    keys, idfs = known
    if len(keys):
        at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
        hit = keys[at] == value
        out[hit] = idfs[at[hit]]
    return out


def plain_bands(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and their ``PLAIN`` bands of two unweighted min-hashes."""
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, dtype=np.int64)
    out = np.empty((len(begin), PLAIN), dtype=np.uint64)
    for k in range(PLAIN if len(begin) else 0):
        one, two = (np.minimum.reduceat(mix(value ^ np.uint64(1009 * (2 * k + r + 1))), begin) for r in (0, 1))
        out[:, k] = mix(one ^ mix(two))
    return doc[begin], out


def samples(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles and their ``many`` samples, as hashes."""
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, dtype=np.int64)
    rows = doc[begin]
    out = np.empty((len(rows), many), dtype=np.uint64)
    log_w = np.log(weight).astype(np.float32)
    unit = bool((log_w == 0).all())
    length = np.diff(np.append(begin, len(doc)))
    low16 = np.uint64(0xFFFF)
    keys = mix(np.arange(2 * many, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
    for k in range(many):
        x = value * keys[2 * k]
        x ^= x >> np.uint64(32)
        x *= keys[2 * k + 1]
        x ^= x >> np.uint64(29)
        r = _LOG[x & low16] + _LOG[(x >> np.uint64(16)) & low16]  # Gamma(2, 1)
        c = _LOG[(x >> np.uint64(32)) & low16] + _LOG[x >> np.uint64(48)]
        beta = _UNIT[(x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)]
        t = np.float32(0) if unit else np.floor(log_w / r + beta)
        a = np.log(c) - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(a, begin)
        first = np.flatnonzero(a == np.repeat(least, length))
        first = first[np.searchsorted(first, begin)]
        steps = np.zeros(len(first), dtype=np.uint64) if unit else t[first].astype(np.int64).view(np.uint64)
        out[:, k] = mix(value[first] ^ mix(steps))
    return rows, out


def _distinct_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Digest of each text, and the rows at which a text is met first."""
    raw = data.tobytes()
    digests = [hashlib.md5(raw[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    seen: dict[bytes, int] = {}
    for i, x in enumerate(digests):
        seen.setdefault(x, i)
    return digests, np.array(sorted(seen.values()), dtype=np.int64)


def _distinct(shingle: int, parts: int):
    """(part, key, text, bands) of each text a task meets first, if it has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(0), 1_000_000):
                digests, first = _distinct_texts(data, offsets)
                first = np.array([d for d in first.tolist() if digests[d] not in met], dtype=np.int64)
                met.update(digests)
                doc, value, _ = shingles(data, offsets, shingle)
                rows, bands = plain_bands(doc, value)
                fresh = np.isin(rows, first)
                rows, bands = rows[fresh], np.ascontiguousarray(bands[fresh])
                if len(rows):
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * PLAIN), pa.array(bands.view(np.int64).ravel()))
                    part = [int.from_bytes(digests[d][:6], "little") % parts for d in rows]
                    texts = batch.column(0).slice(i, j - i).take(pa.array(rows))
                    keys = pa.array([digests[d].hex() for d in rows], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), keys, texts, lists], names=["part", "key", "text", "bands"])

    return run


def _part_shingles(table: pa.Table, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, hashes, times) of the texts of a part, some at a time."""
    texts = table.column("text").cast(pa.large_string()).combine_chunks()
    for i, _, data, offsets in text_chunks(texts, 500_000):
        yield i, *shingles(data, offsets, size)


def _sorted_out(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising hashes as steps, and their counts, as byte planes (high planes of steps are
    mostly zero)."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(values).to_bytes(8, "little") + planes + counts.astype("<u4").tobytes())


def _sorted_in(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, dtype=np.uint8, count=8 * n, offset=8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64), np.frombuffer(raw, dtype="<u4", offset=8 + 8 * n)


def _ask(shingle: int, parts: int):
    """A part's distinct shingles with the number of its representatives that hold them,
    by bucket (the top of the hash)."""

    def run(key: tuple, texts: pa.Table, copies: pa.Table) -> pa.Table:
        copied = set(copies.column("key").to_pylist())
        stands = np.array([k not in copied for k in texts.column("key").to_pylist()], dtype=np.uint32)
        found = []
        for i, doc, value, _ in _part_shingles(texts, shingle):
            order, edge = sorted_groups(value)
            found.append((value[order[edge[:-1]]], np.add.reduceat(stands[doc[order] + i], edge[:-1]) if len(order) else stands[:0]))
        values = np.concatenate([v for v, _ in found]) if found else np.empty(0, dtype=np.uint64)
        order, edge = sorted_groups(values)
        counts = np.add.reduceat(np.concatenate([c for _, c in found])[order], edge[:-1]) if len(order) else stands[:0]
        values = values[order[edge[:-1]]]
        bucket = _bucket(values, parts)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(values) else np.zeros(1, dtype=np.int64)
        blobs = [_sorted_out(values[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        give_back()
        return pa.table({"bucket": pa.array(bucket[cuts[:-1]], pa.int32()), "part": pa.array([key[0].as_py()] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary())})

    return run


def _bucket(values: np.ndarray, parts: int) -> np.ndarray:
    return (((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of a bucket and tells each part its shingles of df over 1."""

    def told(parts: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        lists = [_sorted_in(b) for b in blobs]
        values = np.concatenate([v for v, _ in lists])
        whose = np.repeat(np.arange(len(lists)), [len(v) for v, _ in lists])
        order, edge = sorted_groups(values)
        df = np.add.reduceat(np.concatenate([c for _, c in lists]).astype(np.int64)[order], edge[:-1])
        df = np.repeat(df, np.diff(edge))
        many = df > 1
        order, df = order[many], df[many]
        by = np.argsort(whose[order], kind="stable")
        order, df = order[by], df[by]
        cuts = np.searchsorted(whose[order], np.arange(len(lists) + 1))
        rows = [(parts[i], _sorted_out(values[order[a:b]], df[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["part", "blob"])

    now, parts, blobs = None, [], []
    for batch in batches:
        for bucket, part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now and blobs:
                yield from told(parts, blobs)
                parts, blobs = [], []
            now = bucket
            parts.append(part)
            blobs.append(blob)
    if blobs:
        yield from told(parts, blobs)


def _sketch(shingle: int, bands: int, rows: int, total: int):
    """(part, key, bands, heavy) of each text: its bands, and hash and idf of its shingles
    of df over 1."""
    most = idf(1, total)

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        lists = [_sorted_in(b) for b in answers.column("blob").to_pylist()]
        keys = np.concatenate([v for v, _ in lists]) if lists else np.empty(0, dtype=np.uint64)
        order = np.argsort(keys)
        known = keys[order], idf(np.concatenate([c for _, c in lists])[order], total) if lists else np.empty(0)
        names, found, heavy = [], [], []
        label = texts.column("key").to_pylist()
        for i, doc, value, times in _part_shingles(texts, shingle):
            idfs = idf_of(value, known, most)
            row, got = samples(doc, value, times * idfs, bands * rows)
            band = np.zeros((len(row), bands), dtype=np.uint64)
            for r in range(rows):
                band = mix(band ^ got[:, r::rows][:, :bands])
            found.append(band)
            light = idfs != most
            pairs = np.zeros(int(light.sum()), dtype=HEAVY)
            pairs["h"], pairs["idf"] = value[light], idfs[light]
            cuts = np.searchsorted(doc[light], np.append(row, row[-1] + 1)) if len(row) else [0]
            names += [label[i + d] for d in row.tolist()]
            heavy += [pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        flat = np.concatenate(found).view(np.int64).ravel() if found else np.empty(0, dtype=np.int64)
        give_back()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1, dtype=np.int32) * bands), pa.array(flat))
        part = pa.array([key[0].as_py()] * len(names), pa.int32())
        return pa.table({"part": part, "key": pa.array(names, pa.string()), "bands": lists, "heavy": pa.array(heavy, pa.binary())})

    return run


def idf(df, total: int):
    """1 + ln(N / df)."""
    return 1 + np.log(max(total, 1) / np.maximum(df, 1))


def _copies(base: DataFrame) -> DataFrame:
    """(part, key) of the texts that aren't representatives."""
    member = base.select("part", "key", F.posexplode("bands").alias("band", "h"))
    least = member.groupBy("band", "h").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").drop("high")
    return member.join(least, ["band", "h"]).filter("key != low").select("part", "key").distinct()


def _classes(texts: DataFrame, keyed: DataFrame, least: float, shingle: int, bands: int, rows: int, block: int, block_bytes: int) -> DataFrame:
    """(key, first_id, class) of every text that has words."""
    spark = texts.sparkSession
    parts = shuffle_partitions(spark)
    met = texts.select("text").mapInArrow(lean(_distinct(shingle, parts)), "part int, key string, text string, bands array<bigint>")
    met = met.repartition(parts, "part").dropDuplicates(["part", "key"])
    base = stage_by(met, "texts", "part", parts)
    settle(spark)
    copies = stage(_copies(base), "copies")
    total = base.count() - copies.count()
    group = base.select("part", "key", "text").groupBy("part")
    asked = group.cogroup(copies.groupBy("part")).applyInArrow(_ask(shingle, parts), "bucket int, part int, blob binary")
    asked = asked.repartition(parts, "bucket").sortWithinPartitions("bucket")
    answers = stage(asked.mapInArrow(lean(_answer), "part int, blob binary"), "frequencies")
    settle(spark)
    sketched = group.cogroup(answers.groupBy("part")).applyInArrow(_sketch(shingle, bands, rows, total), "part int, key string, bands array<bigint>, heavy binary")
    sketches = stage(sketched, "sketches")
    member = sketches.select("key", F.posexplode("bands").alias("band", "h"))
    ends = member.groupBy("band", "h").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").drop("high")
    stars = member.join(ends, ["band", "h"]).filter("key != low").select(F.col("low").alias("a"), F.col("key").alias("b"))
    rooms = components(stars).select(F.col("node").alias("key"), F.col("component").alias("room"))
    links = stage(_links(base, sketches, rooms, least, shingle, idf(1, total), block, block_bytes), "near-links")
    settle(spark)

    classes = components(links).withColumnRenamed("component", "class")
    nodes = sketches.select("key").join(classes, F.col("key") == F.col("node"), "left").select("key", F.coalesce("class", "key").alias("class"))
    return keyed.groupBy("key").agg(F.min("doc_id").alias("first_id")).join(nodes, "key")


def near_duplicates(
    docs: DataFrame, least: float = 0.8, shingle: int = 5, bands: int = 10, rows: int = 3,
    block: int = 4096, block_bytes: int = 4_000_000, text_col: str = "text",
) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_texts (different texts in
    the class) and kept."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = texts.select("doc_id", F.when(F.col("text").isNotNull(), F.md5(F.col("text"))).alias("key"))
    nodes = alone("near-classes", lambda: _classes(texts, keyed, least, shingle, bands, rows, block, block_bytes))
    named = nodes.groupBy("class").agg(F.min("first_id").alias("class_id"), F.count(F.lit(1)).alias("class_texts"))
    known = nodes.join(named, "class").select("key", "class_id", "class_texts")
    out = keyed.join(known, "key", "left")
    own = F.coalesce("class_id", "doc_id")
    return out.select(
        "doc_id", own.alias("class_id"), F.coalesce("class_texts", F.lit(1).cast("long")).alias("class_texts"),
        F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"),
    )


def _links(base: DataFrame, sketches: DataFrame, rooms: DataFrame, least: float, shingle: int, most: float, block: int, block_bytes: int) -> DataFrame:
    """Links that join what all verified pairs join."""
    chosen = rooms.join(sketches, "key").select("part", "key", "room", "bands", "heavy")
    members = base.select("part", "key", "text").groupBy("part").cogroup(chosen.groupBy("part"))
    members = stage(members.applyInArrow(_with_texts, "key string, room string, bands array<bigint>, heavy binary, text string"), "near-members")
    size = F.octet_length("text")
    total = members.agg(F.sum(size)).first()[0] or 0
    bins = max(2 * shuffle_partitions(base.sparkSession), 4 * total // block_bytes)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum(size) / block_bytes)).cast("int")
    dealt = members.join(members.groupBy("room").agg(blocks.alias("blocks")), "room")
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bin_of = F.concat(F.lit("bin"), F.pmod(F.xxhash64("room"), F.lit(bins)))
    dealt = dealt.select(
        F.when(F.col("blocks") == 1, bin_of).otherwise(F.col("room")).alias("room"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        "key", "mine", "bands", "heavy", "text",
    )

    def linked(key: tuple, table: pa.Table) -> pa.Table:
        keys = table.column("key").combine_chunks()
        side = table.column("mine").to_numpy() if key[1].as_py() != key[2].as_py() else None
        lists = table.column("bands").combine_chunks()
        bands = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
        pairs = np.frombuffer(b"".join(x.as_py() for x in table.column("heavy")), dtype=HEAVY)
        heavy, at = np.unique(pairs["h"], return_index=True)
        a, b = joining_pairs(table.column("text").combine_chunks(), bands, side, shingle, least, (heavy, pairs["idf"][at]), most)
        give_back()
        return pa.table({"a": keys.take(pa.array(a, pa.int64())), "b": keys.take(pa.array(b, pa.int64()))})

    return dealt.groupBy("room", "i", "j").applyInArrow(linked, "a string, b string")


def _with_texts(texts: pa.Table, chosen: pa.Table) -> pa.Table:
    """The chosen texts of a part."""
    at = {k: i for i, k in enumerate(texts.column("key").to_pylist())}
    rows = pa.array([at[k] for k in chosen.column("key").to_pylist()], pa.int64())
    return chosen.drop_columns(["part"]).append_column("text", texts.column("text").take(rows))


def joining_pairs(texts: pa.Array, bands: np.ndarray, side: np.ndarray | None, shingle: int, least: float, known, most: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of rows that share a band and reach ``least``;
    with ``side``, of the pairs whose sides differ."""
    parts = [(i, *shingles(data, offsets, shingle)) for i, _, data, offsets in text_chunks(texts, 1_000_000)]
    doc = np.concatenate([d + i for i, d, _, _ in parts])
    value = np.concatenate([v for _, _, v, _ in parts])
    weight = np.concatenate([t for _, _, _, t in parts]) * idf_of(value, known, most)
    begin = np.searchsorted(doc, np.arange(len(bands) + 1))
    length = np.diff(begin)
    total = np.bincount(doc, weights=weight, minlength=len(bands))
    label = np.arange(len(bands))
    a: list[int] = []
    b: list[int] = []

    def similar(r: int, others: np.ndarray) -> np.ndarray:
        own, own_weight = value[begin[r] : begin[r + 1]], weight[begin[r] : begin[r + 1]]
        at = ragged(begin[others], length[others])
        place = np.minimum(np.searchsorted(own, value[at]), len(own) - 1)
        hit = np.flatnonzero(own[place] == value[at])
        whose = np.repeat(np.arange(len(others)), length[others])[hit]
        low = np.bincount(whose, weights=np.minimum(own_weight[place[hit]], weight[at[hit]]), minlength=len(others))
        return low / (total[r] + total[others] - low) >= least

    for k in range(bands.shape[1]):
        order, edge = sorted_groups(bands[:, k])
        for g in np.flatnonzero(np.diff(edge) > 1):
            bucket = order[edge[g] : edge[g + 1]]
            for x, r in enumerate(bucket[:-1].tolist()):
                rest = bucket[x + 1 :]
                rest = rest[label[rest] != label[r]]
                if side is not None:
                    rest = rest[side[rest] != side[r]]
                if len(rest) and k:  # a pair belongs to the first band it shares
                    rest = rest[~(bands[rest, :k] == bands[r, :k]).any(axis=1)]
                many = 16
                while len(rest):
                    some, rest = rest[:many], rest[many:]
                    for o in some[similar(r, some)].tolist():
                        if label[o] != label[r]:
                            a.append(r)
                            b.append(o)
                            label[label == max(label[o], label[r])] = min(label[o], label[r])
                    rest = rest[label[rest] != label[r]]
                    many = min(many * 4, 1024)
    return a, b

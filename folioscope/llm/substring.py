"""Repeated passages: exact counting of word windows by super-k-mer partitioning.

A window is ``window`` consecutive words.  Its minimiser is the least hash among its
runs of ``gram`` words; consecutive windows with the same minimiser travel together
as one packed string of words (a super-k-mer) to the bucket of that minimiser, so
equal windows always meet in one bucket.  There all windows are sorted; windows of
one run of equal hashes are compared word for word before they count as equal.  What
comes back are word spans covered by repeated windows, keyed by a digest of the
text, and each document loses the words of its spans.

Texts that are equal travel once per chunk of a task, with their number of copies.
The packed strings of a task go out as compressed blocks, one per bucket, at most
``flush`` bytes of them being held.  There are ``buckets_per_partition`` buckets for
each shuffle partition.  A first pass adds up the bytes of every bucket (one number per
bucket comes to the driver); a bucket over ``part_bytes``, such as that of a passage many
documents share, is split by the least of a second hash of the same runs, which equal
windows share too.  What is still larger than ``part_bytes``, because one window occurs
that often, is counted in parts by window hash, block by block: a part holds its hashes
and one text of each repeated window, never the bucket.

Defined results: a null text counts as empty and gives an empty text; documents with
fewer words than the window lose nothing; a window that occurs twice in one document
is repeated; equal documents lose the same words; repeated rows are documents of
their own; a very long text is read whole, as one chunk; an empty table gives no rows;
all columns of the input are carried (a column named like one of the results is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.scratch import lean, shuffle_partitions, small_batches
from folioscope.llm.words import SPACE, Words, mix, ragged, sorted_groups, text_chunks, window_hash, window_min

RUN = 256  # windows in one packed string at most
META = np.dtype([("hi", "<u8"), ("lo", "<u4"), ("start", "<u4"), ("copies", "<u4"), ("bytes", "<u4")])


def super_kmers(words: Words, window: int, gram: int, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and bucket of each super-k-mer.  ``splits``: into
    how many each bucket of a minimiser is split."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.empty(0, dtype=np.int64),) * 3
    grams = window_hash(words.hashes(), gram)
    least = window_min(grams, window - gram + 1)
    bucket = (mix(least) % np.uint64(len(splits))).astype(np.int64)
    many = splits[bucket]
    bucket = (np.cumsum(splits) - splits)[bucket]
    if (many > 1).any():
        second = window_min(mix(grams ^ np.uint64(1)), window - gram + 1)
        bucket += np.where(many > 1, (mix(second) % many.astype(np.uint64)).astype(np.int64), 0)
    whole = words.doc[:n] == words.doc[window - 1 :]
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (bucket[1:] != bucket[:-1]) | ~whole[:-1] | (words.doc[1:n] != words.doc[: n - 1])
    begin = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    new |= place % RUN == 0
    at = np.flatnonzero(new & whole)
    # a run of whole windows ends where the next begins or where windows stop being whole
    edge = np.flatnonzero(new | ~whole)
    end = np.append(edge, n)[np.searchsorted(edge, at, "right")]
    return at, end - at, bucket[at]


def _texts_once(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the different texts, their keys and numbers of copies."""
    raw = data.tobytes()
    texts: dict[bytes, list[int]] = {}
    for d in range(len(offsets) - 1):
        texts.setdefault(hashlib.md5(raw[offsets[d] : offsets[d + 1]]).digest(), [d, 0])[1] += 1
    if len(texts) < len(offsets) - 1:
        keep = np.array([d for d, _ in texts.values()])
        spans = np.diff(offsets)[keep]
        data = data[ragged(offsets[keep], spans)]
        offsets = np.concatenate([[0], np.cumsum(spans)])
    keys = np.frombuffer(b"".join(texts), dtype=np.dtype([("hi", "<u8"), ("lo", "<u4"), ("rest", "<u4")]))
    return data, offsets, keys, np.array([c for _, c in texts.values()], dtype=np.uint32)


def _bucket_bytes(window: int, gram: int, buckets: int):
    """Bytes this task would send to each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), 1_000_000):
                words = Words(*_texts_once(data, offsets)[:2])
                at, many, bucket = super_kmers(words, window, gram, np.ones(buckets, dtype=np.int64))
                place = np.concatenate([[0], np.cumsum(words.ends - words.starts + 1)])
                total += np.bincount(bucket, weights=place[at + many + window - 1] - place[at], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some].astype(np.int64))], names=["bucket", "bytes"])

    return run


def _pack(window: int, gram: int, splits: np.ndarray, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            rows, blobs = [], []
            bucket = np.concatenate([h[0] for h in held])
            meta = np.concatenate([h[1] for h in held])
            data = np.concatenate([h[2] for h in held])
            at = np.concatenate([[0], np.cumsum(meta["bytes"].astype(np.int64))])
            held, size = [], 0
            order, edges = sorted_groups(bucket)
            sent = 0
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                some = order[a:b]
                head = np.frombuffer(b"".join(np.ascontiguousarray(meta[some][c]).tobytes() for c in META.names), dtype=np.uint8)
                body = data[ragged(at[some], meta["bytes"][some].astype(np.int64))]
                blobs.append(len(some).to_bytes(8, "little") + squeeze.compress(head.tobytes() + body.tobytes()))
                rows.append(int(bucket[some[0]]))
                sent += len(blobs[-1])
                if sent > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])
                    rows, blobs, sent = [], [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), 1_000_000):
                data, offsets, keys, copies = _texts_once(data, offsets)
                words = Words(data, offsets)
                at, many, bucket = super_kmers(words, window, gram, splits)
                if not len(at):
                    continue
                packed, place = words.joined()
                begin, end = place[at], place[at + many + window - 1]
                meta = np.zeros(len(at), dtype=META)
                doc = words.doc[at]
                meta["hi"], meta["lo"], meta["copies"] = keys["hi"][doc], keys["lo"][doc], copies[doc]
                meta["start"], meta["bytes"] = at - words.first[doc], end - begin
                body = packed[ragged(begin, end - begin)]
                held.append((bucket.astype(np.int32), meta, body))
                size += len(body)
                if size > flush:
                    yield from out()
        if held:
            yield from out()

    return run


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[8:])
    meta = np.zeros(n, dtype=META)
    at = 0
    for c in META.names:
        kind = META[c]
        meta[c] = np.frombuffer(raw, dtype=kind, count=n, offset=at)
        at += n * kind.itemsize
    return meta, np.frombuffer(raw, dtype=np.uint8, offset=at)


def repeated_windows(meta: np.ndarray, data: np.ndarray, window: int, hashed=window_hash) -> np.ndarray:
    """Spans (hi, lo, start, end) of words covered by windows that occur again."""
    offsets = np.concatenate([[0], np.cumsum(meta["bytes"].astype(np.int64))])
    words = Words(data, offsets)
    n = len(words) - window + 1
    h = hashed(words.hashes(), window)
    whole = words.doc[:n] == words.doc[window - 1 :]
    at = np.flatnonzero(whole)
    order, edges = sorted_groups(h[at])
    at = at[order]
    runs = np.diff(edges)
    head = np.repeat(at[edges[:-1]], runs)
    twice = np.zeros(n, dtype=bool)
    twice[at[meta["copies"][words.doc[at]] > 1]] = True
    pair = np.flatnonzero(np.repeat(runs > 1, runs))
    x, y = at[pair], head[pair]
    twice[x] = True
    other = x != y
    x, y = x[other], y[other]
    if len(x):
        _verify(words, window, x, y, twice, at, edges, runs, meta)
    return _spans(words, meta, twice, window)


def _spans(words: Words, meta: np.ndarray, twice: np.ndarray, window: int) -> np.ndarray:
    """Spans of words covered by the windows marked in ``twice``."""
    hit = np.flatnonzero(twice)
    if not len(hit):
        return np.empty((0,), dtype=[("hi", "<u8"), ("lo", "<u4"), ("start", "<u4"), ("end", "<u4")])
    doc = words.doc[hit]
    cut = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(doc) != 0)])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(hit)) - 1
    out = np.zeros(len(begin), dtype=[("hi", "<u8"), ("lo", "<u4"), ("start", "<u4"), ("end", "<u4")])
    d = doc[begin]
    out["hi"], out["lo"] = meta["hi"][d], meta["lo"][d]
    out["start"] = meta["start"][d] + (hit[begin] - words.first[d])
    out["end"] = meta["start"][d] + (hit[end] - words.first[d]) + window
    return out


class Collision(Exception):
    """Two different windows share a hash."""


def repeated_by_parts(blobs: list[bytes], window: int, parts: int, hashed=window_hash) -> Iterator[np.ndarray]:
    """The spans of ``repeated_windows`` over all blobs, a part of the windows and one
    blob at a time.  Raises Collision before anything of that part is returned."""

    def opened(part: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
        for blob in blobs:
            meta, data = _unpack(blob)
            words = Words(data, np.concatenate([[0], np.cumsum(meta["bytes"].astype(np.int64))]))
            h = hashed(words.hashes(), window)
            mine = (words.doc[: len(h)] == words.doc[window - 1 :]) & (mix(h) % np.uint64(parts) == part)
            yield words, meta, h, mine

    for part in range(parts):
        seen = [np.repeat(h[mine], np.minimum(meta["copies"][words.doc[: len(h)][mine]], 2)) for words, meta, h, mine in opened(part)]
        values = np.sort(np.concatenate(seen))
        again = np.unique(values[1:][values[1:] == values[:-1]])
        if not len(again):
            continue
        first: dict[int, bytes] = {}
        out = []
        for words, meta, h, mine in opened(part):
            at = np.flatnonzero(mine)
            at = at[again[np.minimum(np.searchsorted(again, h[at]), len(again) - 1)] == h[at]]
            packed, place = words.joined()
            raw = packed.tobytes()
            for w, x in zip(at.tolist(), h[at].tolist(), strict=True):
                text = raw[place[w] : place[w + window]]
                if first.setdefault(x, text) != text:
                    raise Collision
            twice = np.zeros(len(h), dtype=bool)
            twice[at] = True
            out.append(_spans(words, meta, twice, window))
        yield np.unique(np.concatenate(out))


def _verify(words, window, x, y, twice, at, edges, runs, meta) -> None:
    """Compare each window with the first of its run of equal hashes; where any
    differs, count that run exactly."""
    packed, place = words.joined()
    raw = packed.tobytes()
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    new = np.concatenate([[True], (np.diff(x) != 1) | (np.diff(y) != 1) | (np.diff(words.doc[x]) != 0) | (np.diff(words.doc[y]) != 0)])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(x)) - 1
    left, right = np.stack([place[x[begin]], place[x[end] + window]], 1).tolist(), np.stack([place[y[begin]], place[y[end] + window]], 1).tolist()
    for (a, b), (c, d) in zip(left, right, strict=True):
        if raw[a:b] != raw[c:d]:
            break
    else:
        return
    for i in np.flatnonzero(runs > 1):  # two different windows share a hash
        some = at[edges[i] : edges[i + 1]]
        same: dict[bytes, list[int]] = {}
        for w in some.tolist():
            same.setdefault(raw[place[w] : place[w + window]], []).append(w)
        for group in same.values():
            twice[group] = len(group) > 1 or meta["copies"][words.doc[group[0]]] > 1


def _count(window: int, part_bytes: int):
    def emit(spans: np.ndarray) -> pa.RecordBatch:
        key = np.zeros(len(spans), dtype=[("hi", "<u8"), ("lo", "<u4")])
        key["hi"], key["lo"] = spans["hi"], spans["lo"]
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(spans), [None, pa.py_buffer(key.tobytes())]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([keys, pa.array(spans["start"].astype(np.int32)), pa.array(spans["end"].astype(np.int32))], names=["key", "start", "end"])

    def settle(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not blobs:
            return
        parts = 1 + sum(zstandard.frame_content_size(b[8:]) for b in blobs) // part_bytes
        if parts > 1:
            try:
                for spans in repeated_by_parts(blobs, window, parts):
                    yield from map(emit, np.array_split(spans, 1 + len(spans) // 100_000))
                return
            except Collision:  # about once in 2^64 pairs of windows: compared all at once
                pass
        metas, bodies = zip(*map(_unpack, blobs), strict=True)
        spans = np.unique(repeated_windows(np.concatenate(metas), np.concatenate(bodies), window))
        yield from map(emit, np.array_split(spans, 1 + len(spans) // 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now:
                    yield from settle(blobs)
                    now, blobs = bucket, []
                blobs.append(blob.as_py())
        yield from settle(blobs)

    return run


def remove_spans(words: Words, row: int, spans: list[tuple[int, int]], raw: bytes, place: np.ndarray) -> tuple[bytes, int]:
    """The kept words of one document joined by a space, and how many were removed."""
    a, b = int(words.first[row]), int(words.first[row + 1])
    gone = np.zeros(b - a + 1, dtype=np.int64)
    for s, e in spans:
        gone[s] += 1
        gone[e] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], keep.astype(np.int8), [0]])))
    pieces = [raw[place[a + s] : place[a + e]] for s, e in zip(edge[::2], edge[1::2], strict=True)]
    return b"".join(pieces)[:-1], int((~keep).sum())


def remove_repeated(docs: DataFrame, window: int = 35, gram: int = 4, text_col: str = "text", buckets_per_partition: int = 8, flush: int = 16_000_000, part_bytes: int = 24_000_000) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the kept words, one space
    between)."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    small_batches(spark)
    buckets = parts * buckets_per_partition
    texts = docs.select(text_col)
    sizes = texts.mapInArrow(lean(_bucket_bytes(window, gram, buckets)), "bucket int, bytes long").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    splits = np.ones(buckets, dtype=np.int64)
    for row in sizes.filter(F.col("bytes") > part_bytes).collect():  # at most as many rows as buckets
        splits[row["bucket"]] = -(-row["bytes"] // part_bytes)
    packed = texts.mapInArrow(lean(_pack(window, gram, splits, flush)), "bucket int, blob binary")
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    spans = dealt.mapInArrow(lean(_count(window, part_bytes)), "key binary, start int, end int")
    per = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("_spans")).withColumnRenamed("key", "_key")
    fresh = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    own = [f"_c{i}" for i in range(len(fresh))]  # so that no column of ``docs`` clashes
    keyed = docs.select(*(F.col(c).alias(o) for c, o in zip(fresh, own, strict=True)), F.unhex(F.substring(F.md5(F.coalesce(F.col(text_col), F.lit(""))), 1, 24)).alias("_k"))
    joined = keyed.join(per, F.col("_k") == F.col("_key"), "left").select(*own, "_spans")
    schema = T.StructType([docs.schema[c] for c in fresh] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    where = fresh.index(text_col)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_of = batch.column(len(fresh))
            for i, j, data, offsets in text_chunks(batch.column(where)):
                words = Words(data, offsets)
                body, place = words.joined()
                raw = body.tobytes()
                texts, gone = [], []
                for row, spans in enumerate(spans_of.slice(i, j - i)):
                    if spans.is_valid:
                        text, n = remove_spans(words, row, [(s["start"], s["end"]) for s in spans.as_py()], raw, place)
                    else:
                        text, n = raw[place[words.first[row]] : place[words.first[row + 1]]][:-1], 0
                    texts.append(text)
                    gone.append(n)
                columns = [batch.column(c).slice(i, j - i) for c in range(len(fresh))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words.counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], names=[*fresh, "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(lean(cleaned), schema)

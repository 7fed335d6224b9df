"""Byte-level BPE encoding through a distinct-word table, and decoding through an
id-to-piece join.

Encoding.  Tasks cut texts into words (pre-tokens) and group documents into blocks
of about ``block_bytes``.  A block numbers its distinct words in order of first use;
a document becomes the list of its words' numbers.  Both are written, once, to a table
bucketed by block, so texts are cut a single time and nothing hangs on the order in which
the input would be read again.  The distinct words of each block go to a bucket by their
hash, so that a word of the corpus is in one bucket only and is encoded there once,
whatever the number of its blocks.  Its ids go back to each block that asked, and
documents are put together from their numbers, position by position; the numbered
documents don't move again.  Words and ids travel as compressed lists, not as rows.
There are as many buckets as shuffle partitions, so a bucket's words are a task's share of
the distinct words.

Decoding.  The ids of a batch are joined with their pieces by one gather from the table
of pieces (broadcast: it is bounded by the vocabulary, 50,257 pieces for the public file),
the pieces of a document stand one after the other by position, and bytes that are not
UTF-8 become U+FFFD.

Defined results: a null text is encoded like an empty one, to no ids; equal and
repeated rows give equal ids; an empty table gives no rows; columns named like a
result are replaced, all others are carried; null ids decode to an empty text.
Special tokens inside a text are encoded as such, as the library does by default.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from folioscope.llm.scratch import give_back, lean, shuffle_partitions, small_batches, stage_by
from folioscope.llm.words import ragged

# The pre-token pattern of byte-level BPE, with white space spelled out
# because regex engines differ about U+001C to U+001F.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
# Blocks whose letters and digits are the same for both regex engines
# (older assignments of Unicode); a text with any other character is cut by the
# tokenizer's own pre-tokenizer.
SETTLED = r"\u0000-\u052f\u0600-\u06ff\u0900-\u097f\u0e00-\u0e7f\u2000-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fef\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001f5ff"


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _splitter(path: str):
    """A function that cuts a text into words; special tokens are words."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        raise ValueError("not a plain byte-level tokenizer")
    cut = regex.compile(PRE_TOKEN).findall
    odd = regex.compile(rf"[^{SETTLED}]").search
    own = _tokenizer(path).pre_tokenizer.pre_tokenize_str

    def plain(text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in own(text)] if odd(text) else cut(text)

    special = [t["content"] for t in spec["added_tokens"]]
    if not special:
        return plain
    between = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
    known = set(special)

    def words(text: str) -> list[str]:
        if not any(s in text for s in special):
            return plain(text)
        return [w for piece in between.split(text) if piece for w in ([piece] if piece in known else plain(piece))]

    return words


def _pieces(path: str) -> list[bytes]:
    """The bytes of every id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    out: dict[int, bytes] = {}
    for piece, i in spec["model"]["vocab"].items():
        out[i] = bytes(letters[c] for c in piece)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return [out.get(i, b"") for i in range(max(out) + 1)]


def _numbers_out(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as byte planes, the ones of the highest left out if empty."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    top = 4
    while top > 1 and not planes[top - 1].any():
        top -= 1
    return bytes([top]) + planes[:top].tobytes()


def _numbers_in(raw: bytes) -> np.ndarray:
    top = raw[0]
    n = (len(raw) - 1) // top
    planes = np.zeros((4, n), dtype=np.uint8)
    planes[:top] = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(top, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], path: str, block_bytes: int):
    """(words, slices, numbers of each row) of one block after the other; slices are its
    Arrow rows, whose first column is the text."""
    split = _splitter(path)
    seen: dict[str, int] = {}
    numbers: list[np.ndarray] = []
    slices: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        begin = 0
        for i, text in enumerate(batch.column(0)):
            text = text.as_py() or ""
            numbers.append(np.array([seen.setdefault(w, len(seen)) for w in split(text)], dtype=np.uint32))
            size += len(text) + 16
            if size > block_bytes:
                slices.append(batch.slice(begin, i + 1 - begin))
                yield seen, slices, numbers
                seen, numbers, slices, size, begin = {}, [], [], 0, i + 1
        if begin < len(batch):
            slices.append(batch.slice(begin))
    if numbers:
        yield seen, slices, numbers


def _words_out(seen: dict[str, int], buckets: int) -> tuple[list[int], list[bytes]]:
    """A block's distinct words and their numbers, by bucket."""
    squeeze = zstandard.ZstdCompressor(level=3)
    lists: dict[int, list[tuple[bytes, int]]] = {}
    for word, i in seen.items():
        raw = word.encode("utf-8", "surrogatepass")
        lists.setdefault(zlib.crc32(raw) % buckets, []).append((raw, i))
    blobs = []
    for some in lists.values():
        sizes = np.array([len(w) for w, _ in some], dtype=np.uint32)
        parts = _numbers_out(sizes), _numbers_out(np.diff(np.array([0, *(i for _, i in some)], dtype=np.int64)))
        head = len(some).to_bytes(4, "little") + len(parts[0]).to_bytes(4, "little") + len(parts[1]).to_bytes(4, "little")
        blobs.append(squeeze.compress(head + b"".join(parts) + b"".join(w for w, _ in some)))
    return list(lists), blobs


def _cut(path: str, block_bytes: int, buckets: int, schema: pa.Schema):
    """Rows of both kinds: a block's words by bucket, and its numbered documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for seen, slices, numbers in _blocks(batches, path, block_bytes):
            to, blobs = _words_out(seen, buckets)
            n = len(to)
            blank = [pa.nulls(n, f.type) for f in schema][3:]
            yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.array(to, pa.int32()), pa.array(blobs, pa.binary()), *blank], schema=schema)
            at = 0
            for part in slices:
                n = len(part)
                blobs = pa.array([_numbers_out(x) for x in numbers[at : at + n]], pa.binary())
                at += n
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), blobs, *part.columns[1:]], schema=schema)
            block += 1

    return run


def _answer(path: str):
    """Encode the words of a bucket, each once, and return every block its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        squeeze, open_ = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        table: dict[bytes, bytes] = {}
        now = None
        for batch in batches:
            blocks, blobs = [], []
            for bucket, block, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    table, now = {}, bucket
                raw = open_.decompress(blob)
                a, b = int.from_bytes(raw[4:8], "little"), int.from_bytes(raw[8:12], "little")
                sizes, steps = _numbers_in(raw[12 : 12 + a]), _numbers_in(raw[12 + a : 12 + a + b])
                ends = (np.cumsum(sizes.astype(np.int64)) + 12 + a + b).tolist()
                words = [raw[s:e] for s, e in zip([12 + a + b, *ends[:-1]], ends, strict=True)]
                new = [w for w in words if w not in table]
                for w, e in zip(new, tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in new], add_special_tokens=False), strict=True):
                    table[w] = np.array(e.ids, dtype="<u4").tobytes()
                ids = [table[w] for w in words]
                parts = _numbers_out(steps), _numbers_out(np.array([len(i) // 4 for i in ids], dtype=np.uint32)), _numbers_out(np.frombuffer(b"".join(ids), dtype="<u4"))
                blocks.append(block)
                blobs.append(squeeze.compress(b"".join(len(p).to_bytes(4, "little") for p in parts) + b"".join(parts)))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(blobs, pa.binary())], names=["block", "blob"])

    return run


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: list[str] | None = None, block_bytes: int = 12_000_000) -> DataFrame:
    """``keep`` columns of ``docs`` (all, if None) with ids: 32-bit little-endian ids,
    one after the other, as binary."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = shuffle_partitions(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "ids"]
    rows = docs.select(F.col(text_col).alias("_text"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)))
    fields = [T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("blob", T.BinaryType())]
    form = T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in rows.schema.fields[1:])])
    cut = stage_by(rows.mapInArrow(lean(_cut(tokenizer_path, block_bytes, parts, to_arrow_schema(form))), form), "words", "block", parts)
    asked = cut.filter("bucket IS NOT NULL").select("bucket", "block", "blob").repartition(parts, "bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(lean(_answer(tokenizer_path)), "block long, blob binary")
    numbered = cut.filter("bucket IS NULL").drop("bucket")
    out = T.StructType([*form.fields[3:], T.StructField("ids", T.BinaryType())])

    def assemble(texts: pa.Table, lists: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        first, count, flat = _table([open_.decompress(b) for b in lists.column("blob").to_pylist()])
        ids = []
        for blob in texts.column("blob"):
            numbers = _numbers_in(blob.as_py())
            ids.append(flat[ragged(first[numbers], count[numbers])].tobytes())
        give_back()
        return texts.drop_columns(["block", "blob"]).append_column("ids", pa.array(ids, pa.binary()))

    done = numbered.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(assemble, out)
    return done.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "ids")


def _table(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First id, number of ids by word number, and all ids."""
    at, count, flat = [], [], []
    for raw in lists:
        a, b, c = (int.from_bytes(raw[i : i + 4], "little") for i in (0, 4, 8))
        at.append(np.cumsum(_numbers_in(raw[12 : 12 + a]).astype(np.int64)))
        count.append(_numbers_in(raw[12 + a : 12 + a + b]).astype(np.int64))
        flat.append(_numbers_in(raw[12 + a + b : 12 + a + b + c]))
    if not at:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype="<u4")
    where, many = np.concatenate(at), np.concatenate(count)
    counts, first = np.zeros(where.max() + 1, dtype=np.int64), np.zeros(where.max() + 1, dtype=np.int64)
    counts[where] = many
    first[where] = np.cumsum(many) - many
    return first, counts, np.concatenate(flat)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids."""
    small_batches(encoded.sparkSession)
    pieces = encoded.sparkSession.sparkContext.broadcast(_pieces(tokenizer_path))
    columns = [c for c in encoded.columns if c != out_col]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in encoded.schema if f.name != out_col] + [T.StructField(out_col, T.StringType())])
    where = columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces.value, pa.large_binary())
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                raws = [raw or b"" for raw in part.column(where).to_pylist()]
                ends = np.cumsum([0, *(len(raw) // 4 for raw in raws)])
                joined = table.take(pa.array(np.frombuffer(b"".join(raws), dtype="<u4")))  # every id with its piece
                place = np.frombuffer(joined.buffers()[1], dtype=np.int64)[ends].tolist() if ends[-1] else [0] * len(ends)
                data = joined.buffers()[2].to_pybytes() if ends[-1] else b""
                texts = [data[s:e].decode("utf-8", "replace") for s, e in zip(place[:-1], place[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*columns, out_col])

    return encoded.select(*columns).mapInArrow(lean(run), schema)

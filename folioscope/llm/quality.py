"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its features: its words, its pairs of
neighbouring words (a word next to itself is one feature, whichever the word: no sample
shows every word twice; without that 29 of 825 held-out documents of sf0.1 were judged
wrong), and the character n-grams of its words (3, 4 and 5 characters, the
word's borders counting as one), all hashed into ``buckets`` rows.  A softmax over two
outputs reads the average.  Vectors and output are trained together by stochastic
gradient descent in numpy, one document a step, on a bounded sample.

Both the average and the output are linear, so for scoring the model folds into one
number per bucket: the difference of the two outputs for that bucket's vector.  A
document's score is the logistic of the mean of those numbers plus the bias
difference, which is exactly the softmax of the model.

Defined results: null, empty and blank texts have no features and get the score of
the bias; repeated rows, and equal texts under any id, get equal scores, and ties stay
ties; a constant label gives a constant model; without labels every score is 0.5; a null
doc_id is scored like any other, and is not held out unless the digest of the empty text
says so; a very long text is read whole, in one piece; an empty table gives no rows; only
doc_id is carried, whatever the names of other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.labelled import fold, training_sample
from folioscope.llm.scratch import lean, small_batches
from folioscope.llm.words import SPACE, Words, text_chunks

GRAMS = (3, 4, 5)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every character as the number its bytes make, white space as 0, and its row; each
    text begins with a 0 of its own."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.uint64)
    more = np.diff(np.append(at, len(data))) - 1
    for k in (1, 2, 3):
        some = np.flatnonzero(more >= k)
        code[some] = (code[some] << np.uint64(8)) | data[at[some] + k]
    code[SPACE[data[at]]] = 0
    row = np.searchsorted(offsets, at, "right") - 1
    begin = np.searchsorted(at, offsets[:-1])
    return np.insert(code, begin, 0), np.insert(row, begin, np.arange(len(begin)))


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashed feature, row) arrays: words, pairs of words, and n-grams."""
    words = Words(data, offsets)
    shift = np.uint64(64 - bits)
    if not len(words):
        return
    h = words.hashes()
    yield (h >> shift).astype(np.int32), words.doc
    same = words.doc[1:] == words.doc[:-1]
    pair = (h[:-1] * np.uint64(31) + h[1:]) * np.uint64(0x9E3779B97F4A7C15)
    pair[h[:-1] == h[1:]] = 0
    yield (pair[same] >> shift).astype(np.int32), words.doc[1:][same]
    code, row = characters(data, offsets)
    code, row = np.append(code, np.uint64(0)), np.append(row, -1)  # a border after the last word
    letter = code > 0
    rolled, inner = code, np.ones(len(code), dtype=bool)  # inner: all but the first and last are letters
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :]
        inner = inner[: len(rolled)] & (letter[n - 2 : len(code) - 1] if n > 2 else True)
        if n in GRAMS:
            at = np.flatnonzero(inner)
            yield ((rolled[at] + np.uint64(n)) * np.uint64(0xD1342543DE82EF95) >> shift).astype(np.int32), row[at + 1]


def train(texts: list[str], labels: np.ndarray, bits: int = 16, dim: int = 8, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (buckets, dim), output weights (2, dim) and biases (2)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), dtype=np.float32), np.zeros(2, dtype=np.float32)
    bags = []
    for text in texts:
        data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        found = [f for f, _ in features(data, np.array([0, len(data)]), bits)]
        ids, times = np.unique(np.concatenate(found) if found else np.empty(0, dtype=np.int32), return_counts=True)
        bags.append((ids, (times / max(1, times.sum())).astype(np.float32)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            hidden = share @ vectors[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ out
            out -= step * p[:, None] * hidden
            bias -= step * np.float32(0.1) * p
            # a bag's rows share one step: scaled up so that a long text moves its vectors too
            vectors[ids] -= step * np.minimum(share * np.float32(64), 1)[:, None] * back
    return vectors, out, bias


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = 3000, bits: int = 16, **options) -> tuple[np.ndarray, float]:
    """The folded model: one number per bucket, and the bias difference.  Training
    runs in one task over at most ``most`` labelled documents."""
    sample = training_sample(docs, labels, target, most)

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("order", "ascending"), ("text", "ascending")])
        vectors, out, bias = train(rows.column("text").to_pylist(), rows.column("label").to_numpy(), bits, **options)
        folded = (vectors.astype(np.float64) @ (out[1] - out[0]).astype(np.float64)).astype(np.float32)
        return pa.table({"folded": pa.array([folded.tobytes()], pa.binary()), "bias": [float(bias[1] - bias[0])]})

    got = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(one, "folded binary, bias double").first()
    if got is None:
        return np.zeros(1 << bits, dtype=np.float32), 0.0
    return np.frombuffer(got["folded"], dtype=np.float32), got["bias"]


def score_texts(data: np.ndarray, offsets: np.ndarray, folded: np.ndarray, bias: float) -> np.ndarray:
    bits = len(folded).bit_length() - 1
    n = len(offsets) - 1
    total, many = np.zeros(n), np.zeros(n)
    for ids, row in features(data, offsets, bits):
        total += np.bincount(row, weights=folded[ids], minlength=n)
        many += np.bincount(row, minlength=n)
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(many, 1) + bias, -500, 500)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """doc_id, held_out and score of every document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = shared.value
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(2), 500_000):
                s = score_texts(data, offsets, folded, bias)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(s)], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, held_out boolean, score double")

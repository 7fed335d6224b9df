"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded texts.

Folding lower-cases, maps look-alike letters of other alphabets and digits used for
letters to plain ones, and turns everything else that isn't a letter into spaces.
Entries are whole words (" idiot ") or word beginnings (" idio"); one automaton
finds them all in one pass over the text.  A match that lies inside an exception
phrase doesn't count.  The weights of the matches are added up and divided by the
square root of the number of words (plus a constant, so that one hit in a short text
isn't everything); a logistic curve turns that into a score.

The lexicon is a short list of plain insults plus what the labelled sample shows: words and
word beginnings that are far more frequent in toxic than in other documents, judged
by the lower end of a confidence interval of the log odds ratio, which is also their
weight.  A word beginning counts in a document only where two different words have it,
which needs less evidence (``z_stem``) than a single word does (``z``).  Entries with
less than ``share`` of the largest weight are left out: they are chance finds.  The sample is bounded (``most`` documents outside fold 0); counts over it are
exact, and the lexicon is at most ``entries`` long.

Defined results: null, empty and blank texts have no matches and get the lowest
score; repeated rows, and equal texts under any id, get equal scores, and ties stay ties;
without toxic labels only the plain list counts; a null doc_id is scored like any other;
a very long text is matched whole, in one pass; an empty table gives no rows; ``score``
carries doc_id only and ``filter_toxic`` all columns, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.labelled import fold, training_sample
from folioscope.llm.scratch import lean, small_batches, stage

# Insults and abuse in plain English.
INSULTS = [
    "asshole", "bastard", "bitch", "clown", "cretin", "disgusting", "dumbass", "fool", "fuck", "idiot", "imbecile", "jerk", "loser",
    "moron", "pathetic", "scum", "scumbag", "shit", "stupid", "trash", "vermin", "worthless",
]
# Phrases in which an entry is harmless.
EXCEPTIONS = [
    "april fool", "class clown", "clown car", "clown fish", "fool proof", "fools gold", "jerk chicken", "jerk seasoning", "knee jerk", "pond scum",
    "soap scum", "sore loser", "trash bag", "trash bin", "trash can", "trash collection", "trash compactor",
]
# Look-alikes of Latin letters, and digits and signs used for letters.
CYRILLIC_GREEK = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
WEIGHT = 2.0  # of a plain insult that the sample doesn't show
STEMS = (4, 5, 6)
SMOOTH = 20  # words added to the length


class _Fold(dict):
    """Code point -> folded character, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms
            c = chr(code - 0xFEE0).lower()
        out = CYRILLIC_GREEK.get(c) or DIGITS.get(c) or (c if c.isalpha() else " ")
        if code in (0x200B, 0x200C, 0x200D, 0xAD, 0xFEFF):  # invisible ones
            out = ""
        self[code] = out
        return out


_TABLE = _Fold()


def fold_text(text: str) -> str:
    """Folded words between single or more spaces, with a space at both ends.  A sign
    used for a letter counts as one only between or before letters."""
    low = text.lower()
    if "!" in low or "|" in low:  # at the end of a word they are punctuation
        low = low.replace("! ", "  ").replace("!\n", "  ").replace("!!", "  ").replace(" | ", "   ")
        low = low[:-1] if low.endswith("!") else low
    return f" {low.translate(_TABLE)} "


def _entries_of(text: str) -> set[str]:
    words = {w for w in fold_text(text).split(" ") if len(w) > 2}
    stems = Counter(f" {w[:n]}" for w in words for n in STEMS if len(w) > n)
    return {f" {w} " for w in words} | {s for s, k in stems.items() if k > 1}


def learn(sample: DataFrame, entries: int = 1000, share: float = 0.6, z: float = 2.0, z_stem: float = 1.5) -> list[tuple[str, float]]:
    """Entries with weights, the strongest ones first; at most ``entries``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 500):  # equal texts are one document
                part = batch.slice(i, 500)
                seen = (Counter(), Counter())
                for text, label in set(zip(*(c.to_pylist() for c in part.columns), strict=True)):
                    seen[label].update(_entries_of(text))
                keys = list(seen[1].keys() | seen[0].keys())
                columns = [pa.array(keys, pa.string()), *(pa.array([seen[k][x] for x in keys], pa.int64()) for k in (1, 0))]
                yield pa.RecordBatch.from_arrays(columns, names=["entry", "toxic", "clean"])

    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    t, c = n.get(1, 0), n.get(0, 0)
    counts = sample.select("text", "label").mapInArrow(lean(count), "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    sure = F.when(F.col("entry").endswith(" "), z).otherwise(z_stem)
    odds = F.log(a / (t + 1)) - F.log(b / (c + 1)) - sure * F.sqrt(1 / a + 1 / b)
    plain = [f" {w} " for w in INSULTS]
    rows = counts.withColumn("w", odds).filter((F.col("w") > 1) | F.col("entry").isin(plain)).orderBy(F.col("w").desc(), "entry").limit(entries + len(plain)).collect()
    # a plain insult keeps its weight unless the sample shows it in many clean documents
    known = {r["entry"]: (r["w"], r["clean"]) for r in rows}
    strongest = max((w for w, _ in known.values()), default=0.0)
    found = {e: w for e, (w, _) in known.items() if w > max(1.0, share * strongest)}
    for e in plain:
        if e not in found and not (e in known and known[e][1] > 0.002 * c and known[e][0] < 0):
            found[e] = WEIGHT
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))[:entries]


class Matcher:
    """The automaton: entries with their weights, and exception phrases."""

    def __init__(self, lexicon: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        held: dict[str, tuple[int, float]] = {e: (len(e), w) for e, w in lexicon}
        for phrase in EXCEPTIONS:
            held[f" {phrase} "] = (len(phrase) + 2, -1.0)
        for e, v in held.items():
            self.automaton.add_word(e, v)
        self.automaton.make_automaton()

    def raw(self, text: str) -> tuple[float, int, int]:
        """Sum of weights, number of matched words, number of words.  A word counts once, with
        the largest weight of the entries that match it."""
        folded = fold_text(text)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight < 0:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if excused:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in excused)}
        return sum(best.values()), len(best), len(text.split())

    def feature(self, text: str) -> float:
        total, _, words = self.raw(text)
        return math.log1p(10 * total / math.sqrt(words + SMOOTH))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, turns: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method."""
    design = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(turns):
        p = 1 / (1 + np.exp(-design @ w))
        g = design.T @ (p - y) + ridge * w
        h = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", most: int = 12000, entries: int = 1000) -> dict:
    """The model: lexicon, slope and intercept."""
    small_batches(docs.sparkSession)
    sample = stage(training_sample(docs, labels, target, most), "toxic-sample")
    lexicon = learn(sample, entries)
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(shared.value)
        for batch in batches:
            x = [match.feature(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1).cast(pa.float64())], names=["x", "y"])

    rows = sample.select("text", "label").mapInArrow(lean(values), "x double, y double").toPandas().sort_values(["x", "y"])  # two numbers for each of ``most`` documents
    if rows["y"].nunique() < 2:
        slope, intercept = 2.0, -3.0
    else:
        slope, intercept = calibrate(rows["x"].to_numpy(), rows["y"].to_numpy())
    return {"lexicon": lexicon, "slope": max(slope, 0.0), "intercept": intercept}


def _scorer(model: dict):
    match = Matcher(model["lexicon"])

    def one(text: str | None) -> float:
        z = model["slope"] * match.feature(text or "") + model["intercept"]
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

    return one


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """doc_id, held_out and score of every document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _scorer(shared.value)
        for batch in batches:
            s = [one(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, held_out boolean, score double")


def filter_toxic(docs: DataFrame, model: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, all columns as they are."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([one(t.as_py()) < least for t in batch.column(where)], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


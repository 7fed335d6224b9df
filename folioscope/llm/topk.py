"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates are dealt by a hash of their id into blocks of about ``block`` rows; every
candidate travels once, to its block, and every query travels to each block.  In a block
every dimension has a list of its rows sorted by that component, made once.  Queries go
through a block ``batch`` at a time and share their accesses: a step goes deeper into the
lists, at each list from the ends the signs of the batch's queries prefer; a row met for
the first time is scored in full for the queries still walking.  A query's threshold, the
score of an imaginary row made of the components last met on its own ends, falls as the
walk goes down.  When it is under the query's k-th best score, no unseen row can enter,
not even by a tie, and the query stops.  The walk ends when every query has stopped or
every row has been met.  Steps grow geometrically.  The k best of each block meet in one
ranking per query.

How early a walk ends is a matter of the data.  Where few components carry a score, the
bound closes after a small part of the rows; in many dimensions of like spread nearly
every row stands high in some list, and the lists lead to all rows before the bound closes
(``threshold_search`` returns how many rows each query had met).

Defined results: vectors that are null or hold null or non-finite components take no
part, neither as queries nor as candidates; missing trailing components count as 0;
rows repeated in full count once, and two vectors of one id are two candidates; fewer
than k candidates are all returned; an empty table gives no rows; a score times the
rows of a block must stay under 2^62, or an error is raised; extra columns are not
carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.scratch import lean, shuffle_partitions, small_batches

FOUND = "query_id long, vec_id long, score long"
GROWTH = 2  # of a step over the step before it


def floor_scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def _matrix(vectors: pa.ListArray, width: int | None = None) -> np.ndarray:
    """One row per list; cut or filled with zeros to ``width`` (None: the longest)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(lengths), width), dtype=np.int64)
    inside = np.arange(max(width, lengths.max(initial=0)))[None] < lengths[:, None]
    row, column = np.nonzero(inside)
    fits = column < width
    out[row[fits], column[fits]] = flat[fits]
    return out


class Block:
    """Candidates in order of id, and for each dimension their positions in rising
    order of that component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.lists = np.ascontiguousarray(np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32))
        self.largest = int(np.abs(self.rows).max(initial=0))


def threshold_search(block: Block, query_ids: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, position in the block, score) of the k best rows of each query, by score,
    then smaller id, the query's own id left out; and the rows met by each query's end."""
    n, width = block.rows.shape
    most = block.largest * int(np.abs(asked).max(initial=0)) * width
    if most * n >= 1 << 62:
        raise ValueError("scores are too large")
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64  # all exact
    rows, weights = block.rows.astype(kind), asked.astype(kind)
    lowest = -(1 << 62)
    best = np.full((len(asked), k), lowest, dtype=np.int64)  # score * n - position: one order for score and id
    met = np.zeros(len(asked), dtype=np.int64)
    walking, unseen = np.arange(len(asked)), np.ones(n, dtype=bool)
    depth, step, every = 0, max(1, 4 * k // max(1, width)), np.arange(width)
    while depth < n and len(walking) and unseen.any():
        to = min(n, depth + step)
        live = asked[walking]
        high, low = (live > 0).any(axis=0), (live < 0).any(axis=0)
        if width and not live.any(axis=1).all():  # to a zero query any one list leads to all rows
            high[0] = True
        met_now = np.zeros(n, dtype=bool)
        met_now[block.lists[high, n - to : n - depth].ravel()] = True
        met_now[block.lists[low, depth:to].ravel()] = True
        if not width:
            met_now[:] = True
        fresh = np.flatnonzero(met_now & unseen)
        unseen[fresh] = False
        if len(fresh):
            scores = (weights[walking] @ rows[fresh].T).astype(np.int64) * n - fresh
            scores[block.ids[fresh][None] == query_ids[walking][:, None]] = lowest
            both = np.concatenate([best[walking], scores], axis=1)
            best[walking] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        met[walking] = n - int(unseen.sum())
        edge = np.where(live > 0, block.rows[block.lists[:, n - to], every], block.rows[block.lists[:, to - 1], every])
        bound = (live * edge).sum(axis=1)
        kth = best[walking].min(axis=1)
        closed = (kth > lowest) & (bound < -(-kth // n))  # -(-x // n): the score in score * n - position
        walking = walking[~closed]
        depth, step = to, step * GROWTH
    query, at = np.nonzero(best > lowest)
    score = -(-best[query, at] // n)
    return query, score * n - best[query, at], score, met


def _walk(k: int, batch: int):
    """Blocks one after the other: candidates first, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for rows in batches:
            at, asks = rows.column(0).to_numpy(), rows.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(asks) != 0), [True]])) if len(at) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if at[a] != now:
                    now, held, block = at[a], [], None
                part = rows.slice(a, b - a)
                if not asks[a]:
                    held.append(part)
                    continue
                if block is None:
                    vectors = pa.concat_arrays([h.column(3) for h in held]) if held else pa.array([], rows.schema.field(3).type)
                    block = Block(np.concatenate([h.column(2).to_numpy() for h in held]) if held else np.empty(0, dtype=np.int64), _matrix(vectors))
                    held = []
                for i in range(0, len(part), batch):
                    some = part.slice(i, batch)
                    ids = some.column(2).to_numpy()
                    query, position, score, _ = threshold_search(block, ids, _matrix(pa.concat_arrays([some.column(3)]), block.rows.shape[1]), k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(block.ids[position]), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


def search_top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = 8192, batch: int = 256) -> DataFrame:
    """queries, candidates: (vec_id, v array<long>).  query_id, rank, vec_id, score."""
    spark = queries.sparkSession
    small_batches(spark)
    queries, candidates = (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<long>").alias("v")).distinct() for df in (queries, candidates))
    n = F.lit(max(1, math.ceil(candidates.count() / block))).cast("long")
    own = candidates.select(F.pmod(F.xxhash64("vec_id", F.lit("block")), n).alias("b"), F.lit(False).alias("asks"), "vec_id", "v")
    every = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("b"), F.lit(True).alias("asks"), "vec_id", "v")
    dealt = own.unionByName(every).repartition(shuffle_partitions(spark), "b").sortWithinPartitions("b", "asks")
    partial = dealt.mapInArrow(lean(_walk(k, batch)), FOUND)
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return partial.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Near-duplicate vectors through a pivot-permutation index.

A bounded sample gives reference points (pivots).  Every vector is described by its
``prefix`` nearest pivots in order; each of those pivots' inverted lists holds the
vector.  Two vectors are candidates when they share at least ``shared`` pivots of
their prefixes, counted inside the inverted lists: a pair is looked at in the list of
the smallest pivot it shares, so it is counted and verified once.  Candidates are
verified by cosine in double precision.

A list that is longer than ``block`` is divided by a hash of the id into blocks, and
every pair of blocks is a group of its own, so no task holds a whole hot list.
Groups send back link counts per vector and a spanning forest of their links, never
all pairs.  Vectors equal in every component are one class from the start.

The index is fitted on at most ``sample`` vectors of a length (those with the smallest hashes of
their ids); all vectors are indexed.  A sampled vector within twice the link angle of a
pivot isn't taken as one, so a large group of near copies shares its few pivots and
lands in the same lists, however large its part of the table.  Every length of vectors
has pivots and lists of its own.  The number of pivots of a length follows the number of
its vectors, between ``min_pivots`` and ``max_pivots``, so lists keep their length until
the upper bound, after which block pairs take over.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and so do vectors of different lengths; equal vectors
link with each other; rows repeated in full count once and are returned as often as
they came; two vectors of one vec_id are two members of their classes, and each row of the
id gets the larger n_links and the smaller component_id of the two; very long vectors take
as many bytes a list entry as they have; an empty table gives no rows; extra columns are
not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.components import components
from folioscope.llm.scratch import lean, small_batches, stage
from folioscope.llm.topk import usable

LINKS = "a long, b long, n_a long, n_b long"


def choose_pivots(vectors: DataFrame, sample: int, min_pivots: int, max_pivots: int, least: float) -> dict[int, np.ndarray]:
    """Unit vectors by length, a bounded number each, drawn by hash and so the same every
    time; no two within twice the angle of ``least``."""
    far = math.cos(2 * math.acos(least))
    chosen = {}
    for width, n in sorted(tuple(r) for r in vectors.groupBy(F.size("embedding")).count().filter("count > 1").collect()):  # one row per length
        many = int(min(max(n // 64, min_pivots), max_pivots, sample))
        rows = vectors.filter(F.size("embedding") == width).select("embedding").orderBy(F.xxhash64("rep", F.lit("pivot"))).limit(sample).collect()
        points = _units(np.array([r["embedding"] for r in rows], dtype=np.float64).reshape(-1, width))
        taken, free = [], np.ones(len(points), dtype=bool)
        for i in range(len(points)):
            if free[i] and len(taken) < many:
                taken.append(i)
                free &= points @ points[i] < far
        chosen[width] = points[taken]
    return chosen


def _rows(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    whole = lists.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).ravel()))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _linked_pairs(one: pa.Table, two: pa.Table | None, pivot: int, least: float, shared: int):
    """Positions of verified pairs owned by this list."""
    u, p = _units(_rows(one.column("embedding"))), _rows(one.column("prefix"))
    w, q = (u, p) if two is None else (_units(_rows(two.column("embedding"))), _rows(two.column("prefix")))
    local, flat = np.unique(np.concatenate([p.ravel(), q.ravel()]), return_inverse=True)
    marks = np.zeros((len(p) + len(q), len(local)), dtype=np.float32)
    marks[np.repeat(np.arange(len(marks)), p.shape[1]), flat] = 1
    below = local < pivot
    left, right = marks[: len(p)], marks[len(p) :]
    for i in range(0, len(u), 512):
        counts = left[i : i + 512] @ right.T
        owned = left[i : i + 512][:, below] @ right[:, below].T == 0 if below.any() else np.ones_like(counts, dtype=bool)
        x, y = np.nonzero((counts >= shared) & owned)
        if two is None:
            keep = x + i < y
            x, y = x[keep], y[keep]
        for j in range(0, len(x), 65536):
            xs, ys = x[j : j + 65536] + i, y[j : j + 65536]
            ok = np.einsum("ij,ij->i", u[xs], w[ys]) >= least
            yield xs[ok], ys[ok]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node and the least node it is joined with, for links given by node ids."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return nodes, nodes[label]


def link_vectors(vectors: DataFrame, least: float = 0.95, prefix: int = 8, shared: int = 2, block: int = 2048, sample: int = 4096, min_pivots: int = 32, max_pivots: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``
    (vec_id, embedding)."""
    small_batches(vectors.sparkSession)
    kind = vectors.schema["embedding"].dataType  # vectors travel as they came: four bytes a component, not eight
    kind = kind if kind.elementType in (T.FloatType(), T.DoubleType()) else T.ArrayType(T.DoubleType())
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    whole = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    good = rows.filter(whole).distinct()
    members = good.withColumn("key", F.md5(F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")))
    reps = stage(members.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")), "vector-classes")
    n = reps.count()
    none = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return none
    pivots = choose_pivots(reps, sample, min_pivots, max_pivots, least)
    first, total = {}, 0
    for width, points in pivots.items():
        first[width], total = total, total + len(points)
    spread = vectors.sparkSession.sparkContext.broadcast(pivots)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(pa.concat_arrays([batch.column(2)]).offsets.to_numpy())
            for width in np.unique(lengths).tolist():
                if width not in first:  # the only vector of its length
                    continue
                points = spread.value[width]
                length = min(prefix, len(points))
                same = np.flatnonzero(lengths == width)
                for k in range(0, len(same), 4096):
                    part = batch.take(pa.array(same[k : k + 4096]))
                    raw = _rows(pa.chunked_array([part.column(2)]))
                    near = np.argsort(-(_units(raw) @ points.T), axis=1, kind="stable")[:, :length].astype(np.int32) + np.int32(first[width])
                    again = np.repeat(np.arange(len(part)), length)
                    ids = [part.column(i).take(pa.array(again)) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(near.ravel()), _lists(near[again]), _lists(raw[again])], names=indexed.names)

    form = [("rep", T.LongType()), ("copies", T.LongType()), ("pivot", T.IntegerType()), ("prefix", T.ArrayType(T.IntegerType())), ("embedding", kind)]
    indexed = T.StructType([T.StructField(*f) for f in form])
    lists = stage(reps.select("rep", "copies", "embedding").mapInArrow(lean(described), indexed), "pivot-lists")
    sizes = lists.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("split"))  # one row per pivot
    dealt = lists.join(F.broadcast(sizes), "pivot").withColumn("mine", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("split")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1))).drop("split")
    dealt = dealt.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other")

    def linked(key: tuple, table: pa.Table) -> pa.Table:
        pivot, i, j = (x.as_py() for x in key)
        mine = table.column("mine").to_numpy()
        one = table if i == j else table.take(pa.array(np.flatnonzero(mine == i)))
        two = None if i == j else table.take(pa.array(np.flatnonzero(mine == j)))
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n_a", "n_b")})
        if not len(one) or (two is not None and not len(two)):
            return empty
        other = one if two is None else two
        ra, rb = one.column("rep").to_numpy(), other.column("rep").to_numpy()
        ca, cb = one.column("copies").to_numpy(), other.column("copies").to_numpy()
        na, nb = np.zeros(len(ra), dtype=np.int64), np.zeros(len(rb), dtype=np.int64)
        if two is None:
            nb = na
        trees, held = [], 0
        for x, y in _linked_pairs(one, two, pivot, least, min(shared, len(one.column("prefix")[0]))):
            np.add.at(na, x, cb[y])
            np.add.at(nb, y, ca[x])
            trees.append((ra[x], rb[y]))
            held += len(x)
            if held > 1_000_000:  # keep a forest only
                trees, held = [_forest(*map(np.concatenate, zip(*trees, strict=True)))], 0
        if not trees or not sum(len(x) for x, _ in trees):
            return empty
        nodes, roots = _forest(*map(np.concatenate, zip(*trees, strict=True)))
        count = dict(zip(ra.tolist(), na.tolist(), strict=True))
        if two is not None:
            count.update(zip(rb.tolist(), nb.tolist(), strict=True))
        return pa.table({"a": nodes, "b": roots, "n_a": [count[x] for x in nodes.tolist()], "n_b": np.zeros(len(nodes), dtype=np.int64)})

    links = stage(dealt.groupBy("pivot", "i", "j").applyInArrow(linked, LINKS), "vector-links")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n_a").alias("near"))
    joined = components(links).withColumnRenamed("node", "rep")
    known = reps.select("key", "rep", "copies").join(counts, "rep", "left").join(joined, "rep", "left")
    known = members.select("vec_id", "key").join(known, "key").select("vec_id", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    known = known.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("vec_id").join(known, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))

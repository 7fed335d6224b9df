"""Distribution statistics for calibrating a relevance threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.ordered import ranged, running

# The points and thresholds reported by default.
POINTS = (0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
TAUS = (0.50, 0.55, 0.58, 0.60, 0.62, 0.65, 0.70)


def keeps(score: Column, tau: float) -> Column:
    """The one spelling of the threshold: inclusive."""
    return score >= F.lit(tau)


def at_ranks(values: DataFrame, column: str, ranks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The values at given zero-based ranks (a few rows: name, rank and the columns of
    ``by``, within each of which ranks begin anew).

    Equal values are counted first, so what gets a running sum is one row per value;
    ties need no order of their own."""
    by = by or []
    per = values.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    upto = running(ranged(per, [*by, "value"]), ["value"], "n", "hi", by)
    spans = upto.select(*by, "value", (F.col("hi") - F.col("n")).alias("lo"), "hi")
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    asked = F.broadcast(ranks.withColumnsRenamed({c: f"_{c}" for c in by}))  # a few rows a group
    for c in by:
        inside = inside & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return spans.join(asked, inside).select(*by, "name", "value")


def quantiles(values: DataFrame, column: str = "score", points: Sequence[float] = POINTS) -> DataFrame:
    """Nearest-rank quantiles: observed values at the half-even rounded position."""
    n = values.filter(F.col(column).isNotNull()).agg((F.count(F.lit(1)) - 1).alias("last"))
    ranks = n.filter("last >= 0").select("last", F.explode(F.array(*(F.lit(float(p)) for p in points))).alias("name"))
    ranks = ranks.select("name", F.least(F.greatest(F.bround(F.col("name") * F.col("last")), F.lit(0)), F.col("last")).cast("long").alias("rank"))
    return at_ranks(values, column, ranks).select(F.col("name").alias("point"), "value")


def histogram(values: DataFrame, column: str = "score", bins: int = 20) -> DataFrame:
    """(bin, low, high, count) over [min, max]; the last bin is closed; empty bins are
    there with 0; equal values are one bin."""
    known = values.filter(F.col(column).isNotNull())
    ends = known.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter("lo IS NOT NULL")
    ends = ends.withColumn("w", (F.col("hi") - F.col("lo")) / bins).withColumn("k", F.when(F.col("hi") == F.col("lo"), 1).otherwise(bins))
    place = F.when(F.col("w") == 0, 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(column) - F.col("lo")) / F.col("w")).cast("int")))
    counts = known.select(column).join(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ends.select("lo", "hi", "w", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"))
    high = F.when(F.col("k") == 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * F.col("w"))
    return grid.join(F.broadcast(counts), "bin", "left").select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("low"), high.alias("high"), F.coalesce("n", F.lit(0)).cast("long").alias("count"))


def suggest_tau(values: DataFrame, column: str = "score", width: float = 0.02) -> float | None:
    """Middle of the first empty bin to the left of the median's, None without one."""
    known = values.filter(F.col(column).isNotNull())
    low, n = known.agg(F.min(column), F.count(F.lit(1))).first()
    if n < 2 or width <= 0:
        return None
    rank = values.sparkSession.createDataFrame([("median", n // 2)], "name string, rank long")
    median = at_ranks(known, column, rank).first()["value"]
    last = int((median - low) / width)
    filled = known.filter(F.col(column) <= median).select(((F.col(column) - low) / width).cast("long").alias("bin")).distinct().filter(F.col("bin") < last)
    grid = values.sparkSession.range(last).withColumnRenamed("id", "bin")
    empty = grid.join(filled, "bin", "left_anti").agg(F.max("bin")).first()[0]
    return None if empty is None else low + (empty + 0.5) * width


def cost_table(scores: DataFrame, refs: DataFrame, taus: Sequence[float] = TAUS, batch: int = 50) -> DataFrame:
    """For each threshold: candidates kept, different references of them all, requests.

    scores (candidate_key, score), refs (candidate_key, ref).  A reference is reached
    from a threshold on if its best candidate is: one number per reference, so the
    union is a count and not a set."""
    grid = scores.sparkSession.createDataFrame([(float(t),) for t in taus], "tau double")
    best = scores.groupBy("candidate_key").agg(F.max("score").alias("score"))
    reach = refs.join(best, "candidate_key").groupBy("ref").agg(F.max("score").alias("score"))
    count = lambda df, name: grid.join(df.select("score").join(F.broadcast(grid), F.col("score") >= F.col("tau")).groupBy("tau").agg(F.count(F.lit(1)).alias(name)), "tau", "left")
    both = count(scores, "kept").join(count(reach, "refs"), "tau").fillna(0)
    requests = F.ceil(F.col("refs") / batch) + 2 * F.ceil(F.col("kept") / batch)
    return both.select("tau", F.col("kept").cast("long"), F.col("refs").cast("long"), requests.cast("long").alias("requests"))


def quartiles(values: DataFrame, group: str, column: str = "score") -> DataFrame:
    """n, p25, median, p75 (at n/4, n/2, 3n/4) and mean of each group."""
    known = values.filter(F.col(column).isNotNull())
    sizes = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(column).alias("mean"))
    spots = F.map_from_arrays(F.array(*map(F.lit, ("p25", "median", "p75"))), F.array(*(F.floor(k * F.col("n") / 4) for k in (1, 2, 3))))
    ranks = sizes.select(group, F.explode(spots).alias("name", "rank"))
    found = at_ranks(known, column, ranks, [group]).withColumnRenamed(group, "_g")
    out = sizes.join(found, F.col(group).eqNullSafe(F.col("_g"))).groupBy(group, "n", "mean")
    return out.agg(*(F.max(F.when(F.col("name") == p, F.col("value"))).alias(p) for p in ("p25", "median", "p75"))).select(group, "n", "p25", "median", "p75", "mean")


def percentile_cont(values: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """low, one column per point (between the two nearest values, in proportion), high."""
    known = values.filter(F.col(column).isNotNull())
    ends = known.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("n"))
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in points]
    asked = F.array(*(F.struct(F.lit(f"{side}{i}").alias("name"), cut(x).cast("long").alias("rank")) for i, x in enumerate(place) for side, cut in (("a", F.floor), ("b", F.ceil))))
    found = at_ranks(known, column, ends.filter("n > 0").select(F.inline(asked)))
    at = {f"{side}{i}": F.max(F.when(F.col("name") == f"{side}{i}", F.col("value"))).alias(f"{side}{i}") for i in range(len(points)) for side in "ab"}
    wide = found.agg(*at.values()).crossJoin(ends)  # one row beside one row
    between = [(F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (x - F.floor(x))).alias(f"p{round(p * 100):02d}") for i, (p, x) in enumerate(zip(points, place, strict=True))]
    return wide.select("low", *between, "high")


def nearest_to(values: DataFrame, tau: float, column: str = "score", key: str = "candidate_key", limit: int = 10) -> DataFrame:
    return values.withColumn("gap", F.abs(F.col(column) - tau)).orderBy("gap", key).limit(limit)


def frontier_counters(frontier: DataFrame, hits: DataFrame) -> DataFrame:
    """frontier (frontier_key); hits (frontier_key, candidate_key, kept): every hit is
    credited, and nodes without any are there with zeros."""
    counts = hits.groupBy("frontier_key").agg(F.count(F.lit(1)).alias("n_found"), F.count_if("kept").alias("n_kept"))
    return frontier.join(counts, "frontier_key", "left").fillna(0, ["n_found", "n_kept"])


def first_per_node(journal: DataFrame, action: str) -> DataFrame:
    """The relation of each node's first row of an action."""
    rows = journal.filter((F.col("action") == action) & F.col("node_key").isNotNull() & F.col("relation").isNotNull())
    return rows.groupBy("node_key").agg(F.min(F.struct("id", "relation")).alias("f")).select("node_key", F.col("f.id").alias("first_id"), F.col("f.relation").alias("relation"))


def hub_stats(works: DataFrame, cap: int) -> DataFrame:
    """By relation: nodes, nodes above the cap (strictly), sum and maximum of citers."""
    over = F.count_if(F.col("cited_by_count") > cap)
    out = works.groupBy("relation").agg(F.count(F.lit(1)).alias("nodes"), over.alias("over_cap"), F.sum("cited_by_count").alias("citers"), F.max("cited_by_count").alias("largest"))
    return out.orderBy(F.col("citers").desc(), "relation")


def hub_worst(works: DataFrame, limit: int = 10) -> DataFrame:
    return works.select("work_key", "relation", "cited_by_count").orderBy(F.col("cited_by_count").desc(), "work_key").limit(limit)

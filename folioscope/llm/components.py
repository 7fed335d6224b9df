"""Connected components by alternating large-star and small-star steps
(Kiveris et al., 2014), on tables only: no link or label comes to the driver.

Each step is a minimum per node (combined before the shuffle) joined back to the
edges, so a node with very many links is one row on the side of the minimum and a
splittable key on the side of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.scratch import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node reachable) for every node with a link to
    another.  Empty links give an empty table."""
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    links = stage(links, "links")
    state = _state(links)
    while state[0]:
        links = stage(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v"), F.col("v"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    """Rows and a checksum: two equal states are a fixed point."""
    h = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), h).first())

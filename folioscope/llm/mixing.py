"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words.  Inside a source a document's expected copies are
proportional to its worth, scaled so that the expected words meet the target, and held
to ``max_copies``.  Worth is 9000 for a document without words and rises by one with each
of its first thousand words to 10000, so that scraps are drawn somewhat less often than
pages; a column named by ``emphasis`` replaces it (rounded to thousandths, 0 to 1000).  The whole
part of the expected copies is allocated for certain.  The fraction p is the inclusion
probability of one more copy: documents are ranked within their source by the odds of a
uniform number, hashed from doc_id, divided by the odds of p (Rosen's Pareto order
sampling), and the sample takes the head of that ranking up to the words that are left.
One closing document, the one whose size fits the remaining gap best, brings the total to
its target.

Targets are water-filled: shares follow the weights, a source stops at ``max_copies``
times its size, and what it can't take is shared again by weight until no source is
above.  The loop adds up the source table, one row per source, and brings two numbers to
the driver each time.  Documents that would exceed ``max_copies`` are held to it and the
others of their source rise; the scale that does this is read off running sums over the
worths of a source, of which there are at most 1001 (with ``emphasis`` 1,000,001).

Defined results: null or wordless texts have size 0 and are taken 0 words; null
sources form the last source; an empty table gives no rows; repeated rows, and rows that
share a doc_id or have none, are separate documents with a rank of their own (equal
numbers are told apart by size, then by a row number); a null or negative emphasis counts
as 0, which is drawn for certain copies only; a very long document is never cut, its
source may miss the target by up to half of it; ``mix`` carries the columns it is told to,
``mixed_documents`` all, whatever their names.  The same input gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.prefix import ranged, running
from folioscope.llm.scratch import stage

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """sizes: source, source_size (one row per source).  Adds weight and target."""
    order = [F.col("source").asc_nulls_last()]
    ranked = running(ranged(sizes, order, "mix-sources"), order, {"_i": None})
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("_i") % len(weights) + 1).cast("int"))
    table = stage(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    cap = F.col("source_size") * max_copies
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # ends: every turn caps at least one more source
        over = cap.cast("double") < F.lit(level) * F.col("weight")
        fixed, open_weight = table.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        new = (total - fixed) / open_weight
        if new <= level:
            break
        level = new
    return table.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def scales(sized: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """_s (source), source_size, target and _c, by which worth becomes expected copies:
    the sum of least(_c * worth, max_copies) * size is the target.  _c is null where every
    document takes ``max_copies``."""
    per = sized.filter("size > 0").groupBy(F.col("source").alias("_s"), "_w").agg(F.sum("size").alias("_z"))
    down = Window.partitionBy("_s").orderBy(F.col("_w").desc())  # at most as many rows as there are worths
    held = F.coalesce(F.sum("_z").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * max_copies
    rest = F.sum(F.col("_w") * F.col("_z")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumns({"_held": held, "_rest": rest})
    per = per.join(targets.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t")))
    level = F.when(F.col("_rest") > 0, (F.col("target") - F.col("_held")) / F.col("_rest").cast("double"))
    fits = F.when(level * F.col("_w") <= max_copies, F.struct(-F.col("_w"), level.alias("c")))
    found = per.groupBy("_s").agg(F.min(fits)["c"].alias("_c"))
    return targets.join(found, F.col("source").eqNullSafe(F.col("_s")), "left").select(F.col("source").alias("_s"), "source_size", "target", "_c")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, seed: str = "mix", emphasis: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (whole copies taken) and the
    columns of ``carry``."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    size = word_count(F.col("text"))
    if emphasis is None:
        worth = 9000 + F.least(size, F.lit(1000))
    else:
        worth = F.least(F.greatest(F.round(F.coalesce(F.col(emphasis).cast("double"), F.lit(0.0)) * 1000), F.lit(0)), F.lit(1_000_000))
    sized = stage(docs.select("doc_id", "source", size.alias("size"), unit.alias("_u"), worth.cast("long").alias("_w"), *carry), "mix-sizes")
    sums = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sums")
    targets = source_targets(sums, weights, max_copies).drop("weight")
    per = stage(scales(sized, targets, max_copies), "mix-scales")
    wanted = sized.join(per, sized["source"].eqNullSafe(per["_s"])).drop("_s")
    most = F.lit(float(max_copies))
    expected = F.when(F.col("target") <= 0, 0.0).otherwise(F.coalesce(F.least(F.col("_c") * F.col("_w"), most), most))
    wanted = wanted.withColumn("_e", expected).withColumn("_sure", F.floor("_e")).withColumn("_p", F.col("_e") - F.col("_sure"))
    odds = F.col("_u") / (1 - F.col("_u"))
    rank = F.when((F.col("_p") > 0) & (F.col("size") > 0), odds * (1 - F.col("_p")) / F.col("_p"))
    wanted = wanted.withColumn("_q", rank)
    order = [F.col("source"), F.col("_q").asc_nulls_last(), F.col("doc_id"), F.col("size")]
    wanted = ranged(wanted, order, "mix-ranked")
    wanted = wanted.withColumn("_drawn", F.when(F.col("_q").isNull(), F.lit(0)).otherwise(F.col("size")))
    cut = running(wanted, order, {"_before": "_drawn", "_row": None}, ["source"])
    sure = wanted.groupBy("source").agg(F.sum(F.col("_sure") * F.col("size")).alias("_certain")).withColumnRenamed("source", "_s")
    cut = cut.join(sure, cut["source"].eqNullSafe(sure["_s"])).drop("_s")
    room = F.col("target") - F.col("_certain")
    cut = cut.withColumn("_in", F.col("_q").isNotNull() & (F.col("_before") + F.col("size") <= room))
    gap = F.max(room) - F.sum(F.when(F.col("_in"), F.col("size")).otherwise(0))
    gaps = cut.groupBy("source").agg(gap.alias("_gap")).withColumnRenamed("source", "_s")
    cut = cut.join(gaps, cut["source"].eqNullSafe(gaps["_s"])).drop("_s")
    spare = F.col("_q").isNotNull() & ~F.col("_in") & (F.abs(F.col("_gap") - F.col("size")) < F.col("_gap"))
    best = F.min(F.when(spare, F.struct(F.abs(F.col("_gap") - F.col("size")).alias("miss"), F.col("_row"))))
    closing = cut.groupBy("source").agg(best["_row"].alias("_close")).withColumnRenamed("source", "_s")
    cut = cut.join(closing, cut["source"].eqNullSafe(closing["_s"])).drop("_s")
    extra = F.col("_in") | F.coalesce(F.col("_row") == F.col("_close"), F.lit(False))
    return cut.select("doc_id", "source", "size", "source_size", "target", (F.col("_sure") + extra.cast("long")).alias("copies"), *carry)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.  Rows are
    numbered in a written table, and the numbers, not the ids, lead back to them."""
    own = [f"_c{i}" for i in range(len(docs.columns))]  # so that no column of ``docs`` clashes
    plain = stage(docs.toDF(*own).withColumn("_n", F.monotonically_increasing_id()), "mix-rows")
    emphasis = options.pop("emphasis", None)
    roles = {c: F.col(own[docs.columns.index(c)]) for c in ("doc_id", "source", "text")}
    if emphasis is not None:
        roles["_emphasis"] = F.col(own[docs.columns.index(emphasis)])
    rows = plain.select(*(c.alias(name) for name, c in roles.items()), "_n")
    chosen = mix(rows, emphasis="_emphasis" if emphasis else None, carry=("_n",), **options).filter("copies > 0").select("_n", "copies")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_again")
    return plain.join(chosen, "_n").select(*own, again).drop("_again").toDF(*docs.columns)

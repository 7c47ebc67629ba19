"""Mixing sources to target weights by entropy balancing.

Rates are the entropy-closest to 1 per document (bounded by ``cap``) that meet
each source's token target: ``r = min(cap, exp(lambda_source * size))``.  The
dual is convex in lambda and separates by source; safeguarded Newton steps
solve it over the histogram (source, size, count), which is an exact sufficient
statistic because a rate depends on source and size alone.  All sums that steer
the iteration are exact (rates as integers of 2^-20), so reruns agree.

Rates become whole copies per (source, size) cell by cumulative rounding from
the longest size down, a last fill takes single further copies of sizes that
still fit the gap to the target, and the cell's copies are dealt evenly to its
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, cell_index, global_index, stored, table, unboxed, word_count

#: Rates are integers in units of 1/RATE_ONE.
RATE_ONE = 1 << 20
#: Newton steps per written table, and the most rounds of them.
STEPS, ROUNDS = 4, 25


def source_targets(sizes: DataFrame, weights: tuple = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(skey, source, source_size, target) from (source, skey, size, n).

    Sources by code point, null last, weigh ``weights`` in turn and share all
    sizes; a target stops at ``cap`` times its source's size and the excess is
    shared by weight among the rest until none is above.
    """
    per = sizes.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked, _ = global_index(per, [F.col("source").isNull(), F.col("source")], "_i", "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    src = stored(ranked.withColumn("_w", w).drop("_i"), "weights", light=True)
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        over = F.col("source_size") * cap <= F.lit(level) * F.col("_w")
        n, room, weight = src.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, F.col("source_size") * cap)),
            F.sum(F.when(~over, F.col("_w")))).first()
        if n == capped or not weight:
            break  # no new source reached its cap
        capped, level = n, (total - (room or 0)) / weight
    return src.select("skey", "source", "source_size", F.when(
        F.col("source_size") * cap <= F.lit(level) * F.col("_w"), (F.col("source_size") * cap).cast("double"))
        .otherwise(F.lit(level) * F.col("_w")).alias("target"))


def _rate(cap: int):
    """A document's rate in units of 1/RATE_ONE; ``scale`` is the source's token-weighted mean size."""
    tilted = F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(float(cap))))
    return F.floor(F.least(F.lit(float(cap)), tilted) * RATE_ONE + 0.5).cast("long")


def _newton(cells: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """One safeguarded Newton step of every source's dual."""
    tokens = (F.col("size") * F.col("n")).cast("decimal(20,0)")
    j = cells.join(state, "skey").withColumn("r", _rate(cap))
    free = F.when(F.col("r") < cap * RATE_ONE, F.col("r")).otherwise(0)
    g = j.groupBy("skey").agg(
        F.first("scale").alias("scale"), F.first("target").alias("target"), F.first("lam").alias("lam"),
        F.first("lo").alias("lo"), F.first("hi").alias("hi"),
        F.sum(tokens * F.col("r")).alias("_g"), F.sum(tokens * F.col("size") * free).alias("_d"))
    gap = F.col("_g").cast("double") / RATE_ONE - F.col("target")
    slope = F.col("_d").cast("double") / RATE_ONE / F.col("scale")
    lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
    hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
    step = F.col("lam") - gap / F.when(slope > 0, slope)
    g = g.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_gap", gap).withColumn("_step", step)
    # A step that leaves the bracket (or has no slope) becomes a bisection.
    ok = F.col("_step").isNotNull() & (F.col("_step") > F.col("_lo")) & (F.col("_step") < F.col("_hi"))
    near = F.abs(F.col("_gap")) <= F.col("target") * 1e-5 + 0.5
    done = near | (F.col("_hi") - F.col("_lo") <= 1e-12 * (1 + F.abs(F.col("lam"))))
    return g.select("skey", "scale", "target", F.when(done, F.col("lam")).when(ok, F.col("_step"))
                    .otherwise((F.col("_lo") + F.col("_hi")) / 2).alias("lam"),
                    F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), done.alias("done"))


def mix(docs: DataFrame, weights: tuple = (1, 2, 3), cap: int = 3) -> DataFrame:
    """doc_id, tie, source, size, source_size, target, copies, taken: one row per row of ``docs``.

    A size is the number of words (null text: 0).  A null source is a source of
    its own, last in order.  Documents of size 0 take part with 0 copies.  Rows
    that repeat a doc_id are separate documents, told apart by ``tie`` (a hash
    of the text, so equal rows may swap copies without any difference).  An empty table
    gives no rows.  Other columns are not read.
    """
    sized = stored(docs.select(
        "doc_id", F.xxhash64("text").alias("tie"), "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("skey"),
        word_count(F.col("text")).alias("size")), "sizes")
    cells = stored(sized.groupBy("skey", "source", "size").agg(F.count(F.lit(1)).alias("n")), "cells", light=True)
    targets = stored(source_targets(cells, weights, cap), "targets", light=True)
    cells = cells.drop("source").filter("size > 0")

    scale = cells.groupBy("skey").agg((F.sum(F.col("size").cast("double") * F.col("size") * F.col("n"))
                                       / F.sum(F.col("size") * F.col("n"))).alias("scale"), F.min("size").alias("least"))
    # At hi every rate is at its cap; below lo every rate is 0 in units of 1/RATE_ONE.
    state = stored(scale.join(targets.select("skey", "target"), "skey").select(
        "skey", "scale", "target", F.lit(0.0).alias("lam"),
        (-15.0 * F.col("scale") / F.col("least")).alias("lo"), (2.0 * F.col("scale") / F.col("least")).alias("hi"),
        F.lit(False).alias("done")), "dual", light=True)
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            state = _newton(cells, state.drop("done"), cap)
        state = stored(state, "dual", light=True)
        if state.filter("NOT done").isEmpty():
            break

    # Cumulative rounding over the sizes of a source, longest first.
    first = Window.partitionBy("skey").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rated = cells.join(state.drop("done"), "skey").withColumn("_m", _rate(cap) * F.col("n"))
    rated = rated.withColumn("_c", F.sum("_m").over(first))
    rounded = stored(rated.select("skey", "size", "n", "target", F.expr(
        f"least({cap} * n, _c DIV {RATE_ONE} - (_c - _m) DIV {RATE_ONE})").alias("m")), "rounded", light=True)

    # The gap that is left is filled with sizes that fit, longest first; each
    # round takes every size that fits whole and part of the next, so the gap shrinks below it.
    upto = Window.partitionBy("skey").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    while True:
        gap = rounded.groupBy("skey").agg((F.first("target") - F.sum(F.col("m") * F.col("size"))).cast("long").alias("gap"))
        fits = rounded.join(gap, "skey").filter((F.col("size") <= F.col("gap")) & (F.col("m") < cap * F.col("n")))
        want = ((F.lit(cap) * F.col("n") - F.col("m")) * F.col("size"))
        fits = fits.withColumn("_w", want).withColumn("_b", F.sum("_w").over(upto) - F.col("_w"))
        extra = fits.select("skey", "size", F.expr("least(_w, greatest(0L, gap - _b)) DIV size").alias("_x")).filter("_x > 0")
        filled = stored(rounded.join(extra, ["skey", "size"], "left").select(
            "skey", "size", "n", "target", (F.col("m") + F.coalesce("_x", F.lit(0))).alias("m"),
            F.coalesce("_x", F.lit(0)).alias("_x")), "filled", light=True)
        rounded = filled.drop("_x")
        if filled.filter("_x > 0").isEmpty():
            break

    indexed = cell_index(sized, ["skey", "size"], ["doc_id", "tie"], "_i")
    dealt = (indexed.join(targets.drop("source"), "skey")
             .join(rounded.select("skey", "size", "n", "m"), ["skey", "size"], "left"))
    copies = F.expr("coalesce(((_i + 1) * m) DIV n - (_i * m) DIV n, 0L)")
    return dealt.withColumn("copies", copies).select(
        "doc_id", "tie", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The rows of ``docs``, each repeated as often as the mix takes it; extra columns go along whatever their names."""
    shares = mix(docs, weights, cap).groupBy("doc_id", "tie").agg(
        F.sum("copies").alias("_c"), F.count(F.lit(1)).alias("_rows")).filter("_c > 0")
    shares = shares.select(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), "_c", "_rows")
    keyed = boxed(docs, "doc_id", "text").withColumn("_k", F.xxhash64("text"))
    joined = keyed.join(shares, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t")))
    copies = F.expr("CAST(_c DIV _rows + IF(_nth <= _c % _rows, 1, 0) AS INT)")
    nth = Window.partitionBy("_d", "_t").orderBy(F.lit(1))
    # Equal rows share their copies; all but those of a repeated doc_id are alone in their window.
    repeated = joined.filter("_rows > 1").withColumn("_nth", F.row_number().over(nth))
    alone = joined.filter("_rows = 1").withColumn("_nth", F.lit(1))
    dealt = alone.unionByName(repeated).withColumn("_copies", copies).filter("_copies > 0")
    return unboxed(dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))), docs.columns)


def op2_entropy_mix(spark, sf_dir) -> DataFrame:
    """The mix of all documents to the weights 1, 2, 3 in turn."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")

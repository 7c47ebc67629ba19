"""Cluster aggregation.

Per-cluster statistics are a ``groupBy(center_rank)``: Catalyst splits it into a
partial ``HashAggregate`` in every map task (the reference's combiner), an
exchange of at most k rows per task, and a final merge.  A cluster holding a
third of all points therefore costs one partial row per task, never a hot
reducer.  Results are joined to the centre list (k rows, bounded) so empty
clusters keep their centre.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.average import (
    keep_or_move,
    merge_partials_agg,
    point_partial,
    seed_partial,
    sentinel_included,
    truncated_mean,
    truncated_mean_of,
)
from ..functions.constants import MODES
from ..functions.geometry import point_text
from .uneven import join_by_size


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be 'plain' or 'combined', got {mode!r}")
    return mode


def _weighted(c: str, weight: str | None) -> Column:
    return F.col(c).cast("long") * F.col(weight).cast("long") if weight else F.col(c)


def cluster_stats(assigned: DataFrame, mode: str = "combined", rank_col: str = "center_rank", x: str = "x",
                  y: str = "y", weight: str | None = None) -> DataFrame:
    """A1: per centre ``sum_x, sum_y, n`` (the mean's inputs) and ``n_points``.

    plain mode leaves sentinel points (x = -1) out of the sums and ``n`` (F6);
    ``n_points`` always counts every assigned point.
    """
    _mode(mode)
    total = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    if mode == "plain":
        inc = sentinel_included(x)
        n = F.sum(F.when(inc, F.col(weight).cast("long"))) if weight else F.count(F.when(inc, F.lit(1)))
        sums = [F.sum(F.when(inc, _weighted(x, weight))), F.sum(F.when(inc, _weighted(y, weight)))]
    else:
        n = total
        sums = [F.sum(_weighted(x, weight)), F.sum(_weighted(y, weight))]
    return assigned.groupBy(F.col(rank_col).alias("center_rank")).agg(
        sums[0].cast("long").alias("sum_x"),
        sums[1].cast("long").alias("sum_y"),
        n.cast("long").alias("n"),
        total.cast("long").alias("n_points"),
    )


def apply_stats(stats: DataFrame, centers: DataFrame, mode: str = "combined",
                only_seed: str | None = None) -> DataFrame:
    """J2 + F9: centres LEFT JOIN their statistics → ``rank, old_x, old_y, new_x, new_y, n_points``.

    Both sides hold one row per centre when used as intended; how to join them is
    left to the planner, which sees their sizes.
    """
    _mode(mode)
    old = centers.select("rank", F.col("x").alias("old_x"), F.col("y").alias("old_y"))
    joined = old.join(stats, old["rank"] == stats["center_rank"], "left")
    return joined.select(
        F.col("rank"),
        F.col("old_x"),
        F.col("old_y"),
        keep_or_move(mode, "old_x", "sum_x", only_seed=only_seed).alias("new_x"),
        keep_or_move(mode, "old_y", "sum_y", only_seed=only_seed).alias("new_y"),
        F.coalesce(F.col("n_points"), F.lit(0)).cast("long").alias("n_points"),
    )


def partials(assigned: DataFrame, by: Sequence[str], mode: str = "combined",
             rank_col: str = "center_rank", x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """A2: one mergeable partial per (split, centre) — the combiner's output, made visible.

    ``by`` names the split columns (input split, file, date…); each partial carries
    ``sum_x, sum_y, n, only_seed`` (A4) and ``n_points``.  In plain mode a sentinel
    point (x = -1) adds nothing to the sums or ``n`` but is a point of its cluster.
    """
    _mode(mode)
    points = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    point = point_partial(x, y, weight)
    if mode == "plain":
        inc = sentinel_included(x)
        names = ("sum_x", "sum_y", "n", "only_seed")
        point = [F.when(inc, c).otherwise(z).alias(name) for c, z, name in zip(point, seed_partial(), names)]
    parts = assigned.select(*by, F.col(rank_col).alias("center_rank"), *point, points.alias("n_points"))
    return parts.groupBy(*by, "center_rank").agg(*merge_partials_agg(), F.sum("n_points").alias("n_points"))


def seeds(centers: DataFrame) -> DataFrame:
    """The per-centre zero partials (the reference's dummy records)."""
    return centers.select(F.col("rank").alias("center_rank"), *seed_partial())


def merge_partials(partial_rows: DataFrame, centers: DataFrame, mode: str = "combined") -> DataFrame:
    """A3 + O3: UNION ALL of seeds and partials, merged per centre, then finalised.

    Gives exactly the rows of ``apply_stats(cluster_stats(...))``.
    """
    _mode(mode)
    cols = ["center_rank", "sum_x", "sum_y", "n", "only_seed", "n_points"]
    merged = (
        seeds(centers).withColumn("n_points", F.lit(0).cast("long")).unionByName(partial_rows.select(*cols))
        .groupBy("center_rank").agg(*merge_partials_agg(), F.sum("n_points").alias("n_points"))
    )
    return apply_stats(merged, centers, mode, only_seed="only_seed" if mode == "combined" else None)


def finalize_partials(merged: DataFrame) -> DataFrame:
    """A4 evaluation: truncated averages of merged partials (NULL for a seed-only partial)."""
    return merged.select(
        "*",
        F.when(F.col("n") > 0, truncated_mean("sum_x", "n")).alias("avg_x"),
        F.when(F.col("n") > 0, truncated_mean("sum_y", "n")).alias("avg_y"),
    )


def members(assigned: DataFrame, x: str = "x", y: str = "y", keep: Sequence[str] = (),
            averages: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """A5: each cluster's members with the cluster's truncated average, one row per point.

    The reference concatenates a cluster's members into one ``(x,y) (x,y) …``
    text.  A cluster may hold a third of all points, so the list stays in long
    form (``member`` is the point text) and the per-cluster average — one row per
    centre — is joined back to the points.  ``averages`` (``center_rank, avg_x, avg_y,
    n_members``), such as a round has already computed, spares the first of two
    reads of the points; a short one is a local relation that the planner broadcasts, a
    table goes through ``join_by_size``, which keeps large clusters out of the shuffle.
    """
    if averages is None:
        averages = assigned.groupBy("center_rank").agg(
            truncated_mean_of(x).alias("avg_x"), truncated_mean_of(y).alias("avg_y"), F.count(F.lit(1)).alias("n_members"))
        joined = join_by_size(assigned, averages, "center_rank", "n_members", hot_rows)
    elif hot_rows is not None:
        joined = join_by_size(assigned, averages, "center_rank", "n_members", hot_rows)
    else:
        joined = assigned.join(averages, "center_rank")
    return joined.select(
        *keep, "center_x", "center_y", "avg_x", "avg_y", "n_members", x, y, point_text(x, y).alias("member")
    )


def _qi(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def seeded_stats(assigned: DataFrame, centers: DataFrame, mode: str = "combined", rank_col: str = "center_rank",
                 x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """O3 + A1: UNION ALL of one seed row per centre and the assigned points, grouped by centre.

    This is the reference's own plan — every centre contributes a dummy record so
    an empty cluster still reaches the aggregate — expressed as a union with a
    k-row local relation.  No join: the seed rows carry the old coordinates.
    Catalyst aggregates partially in every map task, so only ≤ k rows per task
    are shuffled.  Returns ``center_rank, old_x, old_y, sum_x, sum_y, n, n_points``.
    """
    _mode(mode)
    w = f"CAST({_qi(weight)} AS BIGINT)" if weight else None
    pts = assigned.selectExpr(
        f"{_qi(rank_col)} AS center_rank", "CAST(NULL AS INT) AS old_x", "CAST(NULL AS INT) AS old_y",
        f"{_qi(x)} AS x", f"{_qi(y)} AS y", f"{w if w else 'CAST(1 AS BIGINT)'} AS w",
    )
    seed = centers.selectExpr("rank AS center_rank", "x AS old_x", "y AS old_y", "CAST(NULL AS INT) AS x",
                              "CAST(NULL AS INT) AS y", "CAST(NULL AS BIGINT) AS w")
    inc = "x IS NOT NULL AND x <> -1" if mode == "plain" else "x IS NOT NULL"
    if w:
        sums = {"sum_x": f"sum(CASE WHEN {inc} THEN CAST(x AS BIGINT) * w END)",
                "sum_y": f"sum(CASE WHEN {inc} THEN CAST(y AS BIGINT) * w END)",
                "n": f"sum(CASE WHEN {inc} THEN w END)",
                "n_points": "sum(w)"}
    else:
        sums = {"sum_x": f"sum(CASE WHEN {inc} THEN x END)",
                "sum_y": f"sum(CASE WHEN {inc} THEN y END)",
                "n": f"count(CASE WHEN {inc} THEN 1 END)",
                "n_points": "count(x)"}
    return seed.unionByName(pts).groupBy("center_rank").agg(
        F.expr("max(old_x)").alias("old_x"), F.expr("max(old_y)").alias("old_y"),
        *[F.expr(f"CAST({e} AS BIGINT)").alias(name) for name, e in sums.items()],
    )


def finalize_stats(stats: DataFrame, mode: str = "combined") -> DataFrame:
    """F5 + F9 on seeded statistics → ``rank, new_x, new_y, old_x, old_y, n_points``."""
    _mode(mode)
    keep = "coalesce(sum_x, 0) = 0" if mode == "plain" else "coalesce(n, 0) = 0"
    return stats.selectExpr(
        "center_rank AS rank",
        f"CASE WHEN {keep} THEN old_x ELSE CAST(sum_x div n AS INT) END AS new_x",
        f"CASE WHEN {keep} THEN old_y ELSE CAST(sum_y div n AS INT) END AS new_y",
        "old_x", "old_y", "coalesce(n_points, 0) AS n_points",
    )

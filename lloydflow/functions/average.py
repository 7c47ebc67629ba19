"""Mergeable coordinate-average partials and the keep-or-move rule.

A partial is four columns ``sum_x, sum_y, n`` (BIGINT) and ``only_seed``
(BOOLEAN).  The zero element is a *seed* (all sums 0, ``only_seed`` true), which
every centre contributes once so that empty clusters survive.  Merging adds the
sums and ANDs the flag, so a merged partial is still a seed only if nothing but
seeds went in.  Everything here is a plain Column expression: Spark runs the
merge as the partial / final phases of a ``HashAggregate``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import PLAIN_SENTINEL_X

PARTIAL_COLUMNS = ("sum_x", "sum_y", "n", "only_seed")


def point_partial(x: str = "x", y: str = "y", weight: str | None = None) -> list[Column]:
    """A4 ``update``: the partial of one point (or of ``weight`` equal points)."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return [
        (F.col(x).cast("long") * w).alias("sum_x"),
        (F.col(y).cast("long") * w).alias("sum_y"),
        w.alias("n"),
        F.lit(False).alias("only_seed"),
    ]


def seed_partial() -> list[Column]:
    """A4 zero element: the dummy partial every centre contributes once."""
    return [
        F.lit(0).cast("long").alias("sum_x"),
        F.lit(0).cast("long").alias("sum_y"),
        F.lit(0).cast("long").alias("n"),
        F.lit(True).alias("only_seed"),
    ]


def merge_partials_agg() -> list[Column]:
    """A4 ``merge`` as aggregate expressions over partial rows (F7: seeds add nothing)."""
    return [
        F.sum("sum_x").alias("sum_x"),
        F.sum("sum_y").alias("sum_y"),
        F.sum("n").alias("n"),
        F.bool_and("only_seed").alias("only_seed"),
    ]


def partials_equal(left: str, right: str) -> Column:
    """A4 equality: two partial structs are equal when their three sums are."""
    return (
        F.col(f"{left}.sum_x").eqNullSafe(F.col(f"{right}.sum_x"))
        & F.col(f"{left}.sum_y").eqNullSafe(F.col(f"{right}.sum_y"))
        & F.col(f"{left}.n").eqNullSafe(F.col(f"{right}.n"))
    )


def sentinel_included(x: str = "x") -> Column:
    """plain mode leaves points whose x equals the sentinel out of the mean."""
    return F.col(x) != F.lit(PLAIN_SENTINEL_X)


def truncated_mean(sum_col: str, n_col: str) -> Column:
    """``sum div n`` — BIGINT mean truncated toward zero, as an INT coordinate."""
    return F.expr(f"CAST(`{sum_col}` div `{n_col}` AS INT)")


def truncated_mean_of(coord: str) -> Column:
    """F5 as an aggregate over points: their summed coordinate ``div`` their number."""
    return F.expr(f"CAST(sum(CAST(`{coord}` AS BIGINT)) div count(1) AS INT)")


def keep_old(mode: str, sum_x: str = "sum_x", n: str = "n", only_seed: str | None = None) -> Column:
    """F9 condition: when the old centre is kept instead of moving to the mean.

    plain: the x-sum (sentinel points excluded) is zero — also true for an empty
    cluster; combined: nothing but seeds reached the centre (``only_seed`` when the
    merged flag is at hand, else a zero / missing point count).
    """
    if mode == "plain":
        return F.coalesce(F.col(sum_x), F.lit(0)) == 0
    if mode == "combined":
        if only_seed is not None:
            return F.coalesce(F.col(only_seed), F.lit(True))
        return F.coalesce(F.col(n), F.lit(0)) == 0
    raise ValueError(f"mode must be 'plain' or 'combined', got {mode!r}")


def keep_or_move(mode: str, old: str, sum_col: str, *, sum_x: str = "sum_x", n: str = "n",
                 only_seed: str | None = None) -> Column:
    """the old coordinate when the keep rule holds, else the truncated mean."""
    return F.when(keep_old(mode, sum_x, n, only_seed), F.col(old)).otherwise(truncated_mean(sum_col, n))

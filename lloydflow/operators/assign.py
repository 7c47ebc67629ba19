"""Nearest-centre assignment.

Each point gets the centre with the smallest distance; on equal distance the
centre that comes first in the list (lowest rank) wins, as the reference's
strict ``<`` scan does.  The centre list is small and bounded, so it is bound
into the plan rather than joined: no ``Exchange`` and no pairing of rows —
assignment is a narrow projection over the points.

Two physical forms, same results:

* ``unrolled`` (k ≤ ``UNROLL_LIMIT``): one distance per centre, their
  ``least``, then ``CASE WHEN d0 = m THEN 0 WHEN d1 = m THEN 1 …`` — the first
  branch that reaches the minimum is the lowest rank.  All primitive doubles in
  whole-stage codegen, no per-row objects.  The centre's coordinates are looked
  up by its place in a literal array, so there is one CASE chain, not three.
  Expressions are handed to Spark as SQL text (one call).
* ``vectorized``: an Arrow-batched pandas UDF doing the arg-min with numpy;
  ``argmin`` returns the first minimum, i.e. the lowest rank.  Each point only
  scans the exact candidate list of its cell (see ``candidate_cells``); cells
  follow the density of the centres, so the work per point stays near-constant
  as k grows, also with a few centres far from all others.

Distances are compared as rooted doubles, as the reference does: squared
distances beyond 2^52 that differ may tie after the root, and then the lowest
rank wins.  A point whose distance to every centre is at least 2147483647 has no
centre in the reference (the job fails), nor has a point with a NULL coordinate;
both forms fail the query for such a point with the same message.  The list may
hold any number of centres: above about a megabyte PySpark ships the search
table as a broadcast, once per executor.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import INITIAL_BEST_DISTANCE, UNROLL_LIMIT
from . import nearest_kernel
from .nearest_kernel import candidate_cells, nearest_indices

# The UDF below calls the numpy kernel; ship that module by value so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(nearest_kernel)

Ranked = Sequence[tuple[int, int, int]]

_FAR_MESSAGE = f"point is at distance >= {INITIAL_BEST_DISTANCE} from every centre"
_NULL_MESSAGE = "point coordinate is NULL"


def choose_strategy(k: int, strategy: str = "auto") -> str:
    if strategy == "auto":
        return "unrolled" if k <= UNROLL_LIMIT else "vectorized"
    if strategy not in ("unrolled", "vectorized"):
        raise ValueError(f"unknown assignment strategy {strategy!r}")
    return strategy


def _check(ranked: Ranked) -> None:
    if not ranked:
        raise ValueError("no centres")
    ranks = [r for r, _, _ in ranked]
    if ranks != sorted(ranks) or len(set(ranks)) != len(ranks):
        raise ValueError("centres must be in strictly increasing rank order")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distance_sql(x: str, y: str, cx: int, cy: int) -> str:
    """Distance to a literal centre, as SQL text (DOUBLE; the squares don't wrap)."""
    dx = f"(CAST({_q(x)} AS DOUBLE) - {float(cx)!r}D)"
    dy = f"(CAST({_q(y)} AS DOUBLE) - {float(cy)!r}D)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def _checked(distance: str, rank_sql: str) -> str:
    # The coalesce never applies (raise_error fires first); it keeps the column
    # non-nullable so Catalyst infers no isnotnull filter that would repeat the search.
    return (f"coalesce(CASE WHEN {distance} IS NULL THEN CAST(raise_error('{_NULL_MESSAGE}') AS INT) "
            f"WHEN {distance} >= {float(INITIAL_BEST_DISTANCE)!r}D THEN CAST(raise_error('{_FAR_MESSAGE}') AS INT) "
            f"ELSE {rank_sql} END, -1)")


def _unrolled(points: DataFrame, ranked: Ranked, x: str, y: str, rank_col: str, coords: tuple[str, ...]) -> DataFrame:
    keep = [_q(c) for c in points.columns]
    dcols = [f"__d{i}" for i in range(len(ranked))]
    step1 = points.selectExpr(*keep, *[f"{distance_sql(x, y, cx, cy)} AS {d}"
                                       for d, (_, cx, cy) in zip(dcols, ranked)])
    # A NULL coordinate makes every distance NULL.
    least = dcols[0] if len(dcols) == 1 else "least(" + ", ".join(dcols) + ")"
    step2 = step1.selectExpr(*keep, *dcols, f"{least} AS __m")
    first = "CASE " + " ".join(f"WHEN {d} = __m THEN {i}" for i, d in enumerate(dcols)) + " END"
    step3 = step2.selectExpr(*keep, f"{_checked('__m', first)} AS __at")
    out = list(keep)
    for i, name in enumerate((rank_col, *coords)):
        values = "array(" + ", ".join(str(int(c[i])) for c in ranked) + ")"
        consecutive = i == 0 and [r for r, _, _ in ranked] == list(range(len(ranked)))
        out.append(("__at" if consecutive else f"coalesce({values}[__at], -1)" if i == 0 else f"{values}[__at]") + f" AS {_q(name)}")
    return step3.selectExpr(*out)


_CELLS: dict[bytes, object] = {}


def _cells_for(key: bytes, cx: np.ndarray, cy: np.ndarray):
    """The search cells of a centre list, kept for the last few lists (rounds repeat them)."""
    if key not in _CELLS:
        if len(_CELLS) >= 4:
            _CELLS.pop(next(iter(_CELLS)))
        _CELLS[key] = candidate_cells(cx, cy)
    return _CELLS[key]


def _nearest_udf(ranked: Ranked, with_coords: bool):
    ranks = np.array([r for r, _, _ in ranked], dtype=np.int32)
    cxi = np.array([c for _, c, _ in ranked], dtype=np.int32)
    cyi = np.array([c for _, _, c in ranked], dtype=np.int32)
    cx = cxi.astype(np.float64)
    cy = cyi.astype(np.float64)
    cells = _cells_for(cxi.tobytes() + cyi.tobytes(), cx, cy)  # built on the driver, shipped with the function
    out_type = "d double, rank int, x int, y int" if with_coords else "d double, rank int"

    @F.pandas_udf(out_type)
    def nearest_centre(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        px = xs.to_numpy(dtype=np.float64, na_value=np.nan)
        py = ys.to_numpy(dtype=np.float64, na_value=np.nan)
        null = np.isnan(px) | np.isnan(py)
        if null.any():  # no distance: the check outside fails the query
            px, py = np.where(null, 0.0, px), np.where(null, 0.0, py)
        idx, best = nearest_indices(px, py, cx, cy, cells)
        out = {"d": pd.Series(best).mask(null) if null.any() else best, "rank": ranks[idx]}
        if with_coords:
            out["x"] = cxi[idx]
            out["y"] = cyi[idx]
        return pd.DataFrame(out)

    return nearest_centre


def _vectorized(points: DataFrame, ranked: Ranked, x: str, y: str, rank_col: str, coords: tuple[str, ...]) -> DataFrame:
    keep = [_q(c) for c in points.columns]
    udf = _nearest_udf(ranked, bool(coords))
    step1 = points.select(*points.columns, udf(F.col(x), F.col(y)).alias("__nearest"))
    out = [*keep, f"{_checked('__nearest.d', '__nearest.rank')} AS {_q(rank_col)}"]
    out += [f"__nearest.{field} AS {_q(name)}" for field, name in zip("xy", coords)]
    return step1.selectExpr(*out)


def assign_rank(points: DataFrame, ranked: Ranked, x: str = "x", y: str = "y", strategy: str = "auto",
                rank_col: str = "center_rank") -> DataFrame:
    """J1 core: add the rank of the nearest centre (all other columns kept)."""
    _check(ranked)
    form = choose_strategy(len(ranked), strategy)
    return (_unrolled if form == "unrolled" else _vectorized)(points, ranked, x, y, rank_col, ())


def assign(points: DataFrame, ranked: Ranked, x: str = "x", y: str = "y", strategy: str = "auto",
           prefix: str = "center_") -> DataFrame:
    """Add ``center_rank, center_x, center_y`` of the nearest centre to every point.

    Used for the final listing (J3): only points are listed, so centres without
    points do not appear.
    """
    _check(ranked)
    form = choose_strategy(len(ranked), strategy)
    return (_unrolled if form == "unrolled" else _vectorized)(
        points, ranked, x, y, f"{prefix}rank", (f"{prefix}x", f"{prefix}y"))

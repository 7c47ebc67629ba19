"""Nearest centre among a whole table of centres (J1, J3 beyond what a plan can carry).

``TileIndex`` cuts the centres into tiles of a few thousand: strips by quantiles of x,
ranges by quantiles of y inside a strip.  The driver sees only the cuts and
the bounding box of each tile.  The search is two joins on (pack, salt):

1. Every point meets the centres of the tile it falls in.  A tile with many points
   is dealt to several salts, and its centres go to each of them; tiles with few points
   are packed together, so that a group is worth its cost.  Equal points are
   merged before they are shuffled, so one repeated point is no hot key.  The
   distance found bounds the true one, and nearly all points lie deeper in their
   tile than that bound.
2. The others are sent to the tiles whose box is within their bound, and the smallest
   (distance, rank) per point wins, by aggregation.

The answer is that of ``assign``: rooted distances, lowest rank on ties, the same
errors for a point without coordinates or without a centre in reach.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import INITIAL_BEST_DISTANCE
from ..session import local_frame, written
from . import nearest_kernel, tile_kernel
from .assign import _FAR_MESSAGE, _NULL_MESSAGE
from .tile_kernel import Tiles, merged, nearest_by_tile, sums_by

# Executors need no installed copy of the package: the task functions travel by value.
for _module in (nearest_kernel, tile_kernel, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

#: Centres per tile, and distinct points per join group, aimed at.
TILE_CENTERS = 1024
GROUP_POINTS = 200_000
#: Most tiles with few points that share a join group.
PACK_TILES = 32
#: Points that are looked at to size the groups (their share of the table; results don't depend on it).
SIZING_POINTS = 1_000_000

FOUND = ("x INT, y INT, w BIGINT, d DOUBLE, rank INT, center_x INT, center_y INT, tiles ARRAY<INT>, "
         "sum_x BIGINT, sum_y BIGINT, n BIGINT, n_points BIGINT")
_TILE_SCHEMA = "tile INT, strip INT, x_cut INT, y_cut INT, x0 INT, x1 INT, y0 INT, y1 INT"
_FOUND_COLUMNS = [f.split()[0] for f in FOUND.split(", ")]


@dataclass
class TileIndex:
    """Centres by tile (a written table ``tile, rank, x, y``) and the tiling."""

    centers: DataFrame
    tiles: Tiles

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Write the index below ``path``, for searches of other sessions (a stream's batches, a later job)."""
        t, spark = self.tiles, self.centers.sparkSession
        strips = np.searchsorted(t.first, np.arange(t.n), "right") - 1
        rows = [(i, int(s), *(None if at >= len(cuts) else int(cuts[at]) for at, cuts in ((s, t.x_cuts), (i - t.first[s], t.y_cuts[s]))),
                 int(t.x0[i]), int(t.x1[i]), int(t.y0[i]), int(t.y1[i])) for i, s in enumerate(strips)]
        local_frame(spark, rows, _TILE_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{path}/tiling")
        self.centers.write.mode(mode).parquet(f"{path}/centres")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TileIndex:
        """The index written below ``path``: one row a tile is read, the centres stay where they are."""
        rows = spark.read.parquet(f"{path}/tiling").orderBy("tile").collect()
        x_cuts = {r["strip"]: r["x_cut"] for r in rows if r["x_cut"] is not None}
        y_cuts: list[list[int]] = [[] for _ in range(rows[-1]["strip"] + 1)]
        for r in rows:
            if r["y_cut"] is not None:
                y_cuts[r["strip"]].append(r["y_cut"])
        tiles = Tiles([x_cuts[s] for s in sorted(x_cuts)], y_cuts, [(r["x0"], r["x1"], r["y0"], r["y1"]) for r in rows])
        return TileIndex(spark.read.parquet(f"{path}/centres"), tiles)


def _tile_udf(tiles: Tiles, strips_only: bool = False):
    @F.pandas_udf("int")
    def tile_of(xs: pd.Series, ys: pd.Series) -> pd.Series:
        px, py = xs.to_numpy(np.float64), ys.to_numpy(np.float64)
        return pd.Series(tiles.strip_of(px) if strips_only else tiles.tile_of(px, py), dtype=np.int32)

    return tile_of


def _cuts(quantiles, largest) -> list[int]:
    """Distinct cut values, each with something above it."""
    return sorted({int(q) for q in quantiles if q < largest})


def build_index(centers: DataFrame, per_tile: int = TILE_CENTERS) -> TileIndex:
    """The index of distinct centres ``rank, x, y`` (a written table: it is read four times)."""
    total, x_max = centers.agg(F.count(F.lit(1)), F.max("x")).first()
    if not total:
        raise ValueError("no centres")
    strips = int(np.ceil(np.sqrt(total / per_tile)))
    x_cuts = []
    if strips > 1:
        shares = [i / strips for i in range(1, strips)]
        x_cuts = _cuts(centers.agg(F.percentile_approx("x", shares, 100 * strips)).first()[0], x_max)
    in_strip = centers.withColumn("strip", _tile_udf(Tiles(x_cuts, [[]] * (len(x_cuts) + 1)), strips_only=True)("x", "y"))
    # One row per strip: its size, then as many cuts as it needs.
    sizes = {s: (n, top) for s, n, top in in_strip.groupBy("strip").agg(F.count(F.lit(1)), F.max("y")).collect()}
    ranges = {s: int(np.ceil(n / per_tile)) for s, (n, _) in sizes.items()}
    most = max(ranges.values())
    y_cuts: list[list[int]] = [[] for _ in range(len(x_cuts) + 1)]
    if most > 1:
        shares = [i / most for i in range(1, most)]
        for s, quantiles in in_strip.groupBy("strip").agg(F.percentile_approx("y", shares, 100 * most)).collect():
            n = ranges[s]
            y_cuts[s] = _cuts((quantiles[max(0, round(i * most / n) - 1)] for i in range(1, n)), sizes[s][1])
    tiling = Tiles(x_cuts, y_cuts)
    by_tile = written(centers.select(_tile_udf(tiling)("x", "y").alias("tile"), "rank", "x", "y"), "tiles")
    boxes = {r[0]: r[1:] for r in by_tile.groupBy("tile").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).collect()}
    return TileIndex(by_tile, Tiles(x_cuts, y_cuts, [boxes[t] for t in range(tiling.n)]))


def _routed(points: DataFrame, tiles: Tiles, x: str, y: str, weight: str | None) -> DataFrame:
    """``tile, x, y, w`` of the points, equal ones of a batch merged."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b["x"].isna().any() or b["y"].isna().any():
                raise ValueError(_NULL_MESSAGE)
            px, py, w = merged(b["x"].to_numpy(np.int32), b["y"].to_numpy(np.int32), b["w"].to_numpy(np.int64))
            yield pd.DataFrame({"tile": tiles.tile_of(px.astype(np.float64), py.astype(np.float64)), "x": px, "y": py, "w": w})

    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    plain = points.select(F.col(x).cast("int").alias("x"), F.col(y).cast("int").alias("y"), w.alias("w"))
    return plain.mapInPandas(route, "tile INT, x INT, y INT, w BIGINT")


def _groups(counts: list[tuple[int, int]], n_tiles: int, factor: float) -> pd.DataFrame:
    """``tile, salts, pack`` from (perhaps sampled) point counts: the groups of a large tile, or the pack of a small one."""
    points = np.zeros(n_tiles, np.float64)
    for tile, n in counts:
        points[tile] = n * factor
    salts = np.maximum(1, np.ceil(points / GROUP_POINTS)).astype(np.int64)
    packs, pack, held, size = np.empty(n_tiles, np.int64), 0, 0, 0.0
    for tile in range(n_tiles):
        if held and (held >= PACK_TILES or size + points[tile] > GROUP_POINTS):
            pack, held, size = pack + 1, 0, 0.0
        packs[tile] = pack
        held, size = held + 1, size + points[tile]
    return pd.DataFrame({"tile": np.arange(n_tiles), "salts": salts, "pack": packs})


def _meet(rows: DataFrame, index: TileIndex, groups: pd.DataFrame, search, schema: str) -> DataFrame:
    """``search(points, centres)`` over the groups of (pack, salt), the centres repeated per salt."""
    spark = rows.sparkSession
    # One row a tile, as many as the tiling itself.
    per_tile = F.broadcast(spark.createDataFrame(groups, "tile INT, salts INT, pack INT"))
    salt = F.pmod(F.xxhash64("x", "y"), F.col("salts")).cast("int")
    left = rows.join(per_tile, "tile").select(F.col("pack").alias("group"), salt.alias("salt"), *[rows[c] for c in rows.columns])
    right = (index.centers.join(per_tile, "tile")
             .select(F.col("pack").alias("group"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "tile", "rank", "x", "y"))

    def group(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        return search(points if len(points) else None, centres)

    return left.groupBy("group", "salt").cogroup(right.groupBy("group", "salt")).applyInPandas(group, schema)


def _in_order(centres: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """``tile, x, y, rank`` of a group's centres by tile and rank."""
    tile, cx, cy, rank = (centres[c].to_numpy(np.int32) for c in ("tile", "x", "y", "rank"))
    order = np.lexsort((rank, tile))
    return tile[order], cx[order], cy[order], rank[order]


def _frame(size: int, **columns) -> pd.DataFrame:
    """``size`` rows of ``FOUND``, null in the columns that are not given."""
    return pd.DataFrame({c: columns.get(c, np.full(size, None, object)) for c in _FOUND_COLUMNS})


def _first_search(tiles: Tiles, mode: str | None):
    """Search of the own tile: settled points (summed per centre if ``mode`` is given) and those that may do better elsewhere."""
    def search(points, centres):
        if points is None:
            return _frame(0)
        px, py, w = merged(points["x"].to_numpy(np.int32), points["y"].to_numpy(np.int32), points["w"].to_numpy(np.int64))
        fx, fy = px.astype(np.float64), py.astype(np.float64)
        ct, cx, cy, rank = _in_order(centres)
        own = tiles.tile_of(fx, fy)
        at, d = nearest_by_tile(own, fx, fy, ct, cx.astype(np.float64), cy.astype(np.float64))
        p, t = tiles.within(fx, fy, d, own)
        order = np.argsort(p, kind="stable")
        p, t = p[order], t[order]
        which, starts = np.unique(p, return_index=True)
        others: list = [None] * len(px)
        for i, elsewhere in zip(which, np.split(t, starts[1:])):
            others[i] = elsewhere.tolist()
        open_ = np.zeros(len(px), bool)
        open_[which] = True
        out = _frame(len(px), x=px, y=py, w=w, d=d, rank=rank[at], center_x=cx[at], center_y=cy[at], tiles=others)
        if (d[~open_] >= INITIAL_BEST_DISTANCE).any():
            raise ValueError(_FAR_MESSAGE)
        if mode is None:
            return out
        done = ~open_
        inside = w[done] * ((px[done] != -1) if mode == "plain" else 1)
        key, (sx, sy, n, total) = sums_by(rank[at[done]], px[done] * inside, py[done] * inside, inside, w[done])
        sums = _frame(len(key), rank=key, sum_x=sx, sum_y=sy, n=n, n_points=total)
        return pd.concat([sums.astype(object), out[open_].astype(object)], ignore_index=True) if open_.any() else sums

    return search


def _second_search(points, centres):
    """The nearest centre of another tile for each point sent there."""
    if points is None:
        return pd.DataFrame({c: [] for c in ("x", "y", "d", "rank", "center_x", "center_y")})
    ct, cx, cy, rank = _in_order(centres)
    px, py = points["x"].to_numpy(np.float64), points["y"].to_numpy(np.float64)
    at, d = nearest_by_tile(points["tile"].to_numpy(), px, py, ct, cx.astype(np.float64), cy.astype(np.float64))
    return pd.DataFrame({"x": points["x"].to_numpy(), "y": points["y"].to_numpy(), "d": d, "rank": rank[at],
                         "center_x": cx[at], "center_y": cy[at]})


def _search(points: DataFrame, index: TileIndex, x: str, y: str, weight: str | None, mode: str | None) -> tuple[DataFrame, DataFrame]:
    """(settled rows of the first join, best rows ``x, y, w, d, rank, center_x, center_y`` of the others)."""
    tiles = index.tiles
    share = min(1.0, SIZING_POINTS / max(1, points.count()))
    sized = points.sample(False, share, 7) if share < 1 else points
    counts = [tuple(r) for r in _routed(sized, tiles, x, y, weight).groupBy("tile").count().collect()]  # a row a tile
    routed = _routed(points, tiles, x, y, weight)
    found = written(_meet(routed, index, _groups(counts, tiles.n, 1 / share), _first_search(tiles, mode), FOUND), "first-search")
    settled = found.filter("tiles IS NULL")
    near = found.filter("tiles IS NOT NULL").select("x", "y", "w", "d", "rank", "center_x", "center_y", "tiles")
    sent = near.select("x", "y", F.explode("tiles").alias("tile"))
    counts = [tuple(r) for r in sent.groupBy("tile").count().collect()]
    other = _meet(sent, index, _groups(counts, tiles.n, 1), _second_search, "x INT, y INT, d DOUBLE, rank INT, center_x INT, center_y INT")
    both = near.drop("tiles").unionByName(other.withColumn("w", F.lit(0).cast("long")))
    best = both.groupBy("x", "y").agg(F.sum("w").alias("w"), F.min(F.struct("d", "rank", "center_x", "center_y")).alias("b"))
    return settled, best.select("x", "y", "w", "b.*")


def _reachable(best: DataFrame) -> DataFrame:
    far = F.col("d") >= F.lit(float(INITIAL_BEST_DISTANCE))
    return best.withColumn("rank", F.when(far, F.raise_error(F.lit(_FAR_MESSAGE)).cast("int")).otherwise(F.col("rank")))


def nearest_table(points: DataFrame, index: TileIndex, x: str = "x", y: str = "y") -> DataFrame:
    """``x, y, center_rank, center_x, center_y`` of every distinct point."""
    settled, best = _search(points, index, x, y, None, None)
    columns = ["x", "y", F.col("rank").alias("center_rank"), "center_x", "center_y"]
    return settled.select(*columns).unionByName(_reachable(best).select(*columns))


def assign_table(points: DataFrame, index: TileIndex, x: str = "x", y: str = "y", prefix: str = "center_") -> DataFrame:
    """J1/J3 against a table of centres: add ``center_rank, center_x, center_y`` to every point.

    The search runs over distinct points; its answers join the rows by their coordinates (a
    repeated point is a hot key of the larger side only, which adaptive execution splits).
    """
    found = nearest_table(points, index, x, y)
    named = found.select(F.col("x").alias("__x"), F.col("y").alias("__y"),
                         *[F.col(f"center_{c}").alias(f"{prefix}{c}") for c in ("rank", "x", "y")])
    return points.join(named, (points[x] == F.col("__x")) & (points[y] == F.col("__y"))).drop("__x", "__y")


def stats_table(points: DataFrame, index: TileIndex, mode: str, x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """A1 against a table of centres: ``center_rank, sum_x, sum_y, n, n_points`` of every centre with points.

    Points settled in their own tile leave the search already summed per centre and group.
    """
    settled, best = _search(points, index, x, y, weight, mode)
    inside = F.col("w") * F.when(F.col("x") == -1, 0).otherwise(1) if mode == "plain" else F.col("w")
    rest = _reachable(best).select("rank", (F.col("x") * inside).alias("sum_x"), (F.col("y") * inside).alias("sum_y"),
                                   inside.alias("n"), F.col("w").alias("n_points"))
    sums = ["sum_x", "sum_y", "n", "n_points"]
    return (settled.select("rank", *sums).unionByName(rest).groupBy(F.col("rank").alias("center_rank"))
            .agg(*[F.sum(c).cast("long").alias(c) for c in sums]))

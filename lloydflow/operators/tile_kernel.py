"""Numpy kernels of the tiled nearest-centre search (run inside Spark tasks).

Tiles cut the plane into strips of x and each strip into ranges of y; every tile holds at
least one centre, and ``box`` is the bounding box of its centres.  Only numpy and the
in-memory kernel are used, and both modules are pickled by value.
"""

from __future__ import annotations

import numpy as np

from .nearest_kernel import candidate_cells, nearest_indices


#: Distances from which a search tree over the centres is built first.
_TREE_PAYS = 1 << 24


class Tiles:
    """The cuts and bounding boxes of a tiling: a few numbers per tile."""

    def __init__(self, x_cuts, y_cuts, boxes=None):
        self.x_cuts = np.asarray(x_cuts, np.float64)
        self.y_cuts = [np.asarray(c, np.float64) for c in y_cuts]
        #: First tile of each strip, and the number of tiles.
        self.first = np.concatenate(([0], np.cumsum([len(c) + 1 for c in self.y_cuts]))).astype(np.int64)
        if boxes is not None:
            self.x0, self.x1, self.y0, self.y1 = (np.array(c, np.float64) for c in zip(*boxes))
            ends = list(zip(self.first[:-1], self.first[1:]))
            self.strip_x0 = np.array([self.x0[a:b].min() for a, b in ends])
            self.strip_x1 = np.array([self.x1[a:b].max() for a, b in ends])

    @property
    def n(self) -> int:
        return int(self.first[-1])

    def strip_of(self, px: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.x_cuts, px, "left")

    def tile_of(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """The tile that a point falls in (a cut belongs to the lower side)."""
        strip = self.strip_of(px)
        tile = np.empty(len(px), np.int64)
        for s in np.unique(strip):
            rows = np.flatnonzero(strip == s)
            tile[rows] = self.first[s] + np.searchsorted(self.y_cuts[s], py[rows], "left")
        return tile

    def within(self, px: np.ndarray, py: np.ndarray, reach: np.ndarray, own) -> tuple[np.ndarray, np.ndarray]:
        """(point, tile) pairs: tiles other than ``own`` (one for all, or each point's) whose box is at most ``reach`` from the point.

        Distances to a box are rooted the same way as distances to centres, and rounding keeps
        their order, so no centre as near as ``reach`` is lost, ties included.
        """
        wide = reach * (1 + 1e-12) + 1e-9  # a range may only be too large
        own = np.broadcast_to(own, px.shape)
        low = np.searchsorted(self.strip_x1, px - wide, "left")
        high = np.searchsorted(self.strip_x0, px + wide, "right")
        points, tiles = [], []
        for s in range(int(low.min(initial=0)), int(high.max(initial=0))):
            a, b = self.first[s], self.first[s + 1]
            rows = np.flatnonzero((low <= s) & (s < high))
            if not len(rows):
                continue
            first = a + np.searchsorted(self.y1[a:b], py[rows] - wide[rows], "left")
            last = a + np.searchsorted(self.y0[a:b], py[rows] + wide[rows], "right")
            count = np.maximum(last - first, 0)
            pair = np.repeat(np.arange(len(rows)), count)
            tile = np.repeat(first, count) + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
            p = rows[pair]
            dx = np.maximum(np.maximum(self.x0[tile] - px[p], px[p] - self.x1[tile]), 0.0)
            dy = np.maximum(np.maximum(self.y0[tile] - py[p], py[p] - self.y1[tile]), 0.0)
            keep = (np.sqrt(dx * dx + dy * dy) <= reach[p]) & (tile != own[p])
            points.append(p[keep])
            tiles.append(tile[keep])
        if not points:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(points), np.concatenate(tiles)


def merged(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal points merged, their weights added."""
    if not len(x):
        return x, y, w
    order = np.lexsort((y, x))
    x, y, w = x[order], y[order], w[order]
    new = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    return x[new], y[new], np.add.reduceat(w, np.flatnonzero(new))


def nearest_of(px: np.ndarray, py: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of a tile's centres (first on ties) and its distance."""
    # A search tree pays when it spares many distances.
    return nearest_indices(px, py, cx, cy, candidate_cells(cx, cy) if len(px) * len(cx) > _TREE_PAYS else None)


def nearest_by_tile(pt: np.ndarray, px: np.ndarray, py: np.ndarray, ct: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (first on ties) of each point's own tile ``pt`` and its distance; ``ct`` is in order."""
    at, d = np.empty(len(pt), np.int64), np.empty(len(pt), np.float64)
    order = np.argsort(pt, kind="stable")
    which, starts = np.unique(pt[order], return_index=True)
    for tile, rows in zip(which, np.split(order, starts[1:])):
        a, b = np.searchsorted(ct, tile, "left"), np.searchsorted(ct, tile, "right")
        near, d[rows] = nearest_of(px[rows], py[rows], cx[a:b], cy[a:b])
        at[rows] = a + near
    return at, d


def sums_by(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys and the sum of each column per key."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[at], [np.add.reduceat(c[order], at) if len(key) else c for c in columns]

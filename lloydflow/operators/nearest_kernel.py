"""Numpy kernels of the vectorised nearest-centre search (runs inside Spark tasks).

Only numpy is imported here: the module is pickled by value into the pandas UDF,
so executors do not need this package installed.
"""

from __future__ import annotations

import numpy as np

# Distance cells computed per numpy block (~32 MB of doubles).
_BLOCK_CELLS = 1 << 22
# A cell with at most this many candidates is not split further.
_LEAF = 8
_DEPTH = 48
# Cells with lists up to this width share one padded table; wider ones are searched cell by cell.
_WIDTH = 32


def _nearest(px, py, cx, cy):
    """Arg-min of the rooted distance over all centres in row blocks: first minimum = lowest rank."""
    rows = max(1, _BLOCK_CELLS // len(cx))
    idx = np.empty(len(px), dtype=np.int64)
    best = np.empty(len(px), dtype=np.float64)
    for start in range(0, len(px), rows):
        stop = start + rows
        dx = px[start:stop, None] - cx[None, :]
        dy = py[start:stop, None] - cy[None, :]
        d = np.sqrt(dx * dx + dy * dy)
        i = d.argmin(axis=1)
        idx[start:stop] = i
        best[start:stop] = d[np.arange(len(i)), i]
    return idx, best


def _offsets(c, lo, hi):
    """Smallest and largest distance along one axis from an interval to each centre."""
    return np.maximum(np.maximum(lo - c, c - hi), 0.0), np.maximum(np.abs(c - lo), np.abs(c - hi))


def _cut(cx, cy, mine, box):
    """(axis, coordinate) to split a box at: empty room beside its centres first, else their median."""
    x0, x1, y0, y1 = box
    best = None
    for axis, (c, lo, hi) in enumerate(((cx, x0, x1), (cy, y0, y1))):
        inside = c[mine]
        first, last = float(inside.min()), float(inside.max())
        room = (last - first) / 2 + 1
        if first - lo > 2 * room:
            return axis, first - room
        if hi - last > 2 * room:
            return axis, last + room
        if last > first and (best is None or last - first > best[0]):
            middle = float(np.median(inside))
            best = (last - first, axis, middle if middle < last else (first + last) / 2)
    return best[1:] if best else None


def candidate_cells(cx: np.ndarray, cy: np.ndarray):
    """A tree of boxes over the plane with the exact candidate list of each leaf.

    For a box let U be the smallest, over all centres, of the largest distance
    from the box to that centre.  Every point in the box has its nearest centre
    within U, so only centres whose box distance is at most U can be nearest —
    including every one that ties after the root.  Lists keep rank order, so the
    first minimum is still the lowest rank.  Boxes are split at the median of
    the centres inside, and empty room is cut off first, so the cells follow the
    density of the centres: one far centre costs a few cells.  The plane beyond the
    widened bounding box is a leaf that lists all centres.
    """
    k = len(cx)
    if k <= _LEAF:
        return None
    spread_x, spread_y = float(np.ptp(cx)) / 2 + 1, float(np.ptp(cy)) / 2 + 1
    root = (float(cx.min()) - spread_x, float(cx.max()) + spread_x, float(cy.min()) - spread_y, float(cy.max()) + spread_y)
    axis, cut, child, lists = [], [], [], []

    def grow(box, cands, depth):
        x0, x1, y0, y1 = box
        nx, fx = _offsets(cx[cands], x0, x1)
        ny, fy = _offsets(cy[cands], y0, y1)
        # Widened by a few rounding steps: a bound may only keep too many.
        upper = np.sqrt(fx * fx + fy * fy).min() * (1 + 1e-12)
        cands = cands[np.sqrt(nx * nx + ny * ny) <= upper]
        if len(cands) > _LEAF and depth < _DEPTH:
            mine = cands[(cx[cands] >= x0) & (cx[cands] <= x1) & (cy[cands] >= y0) & (cy[cands] <= y1)]
            at = _cut(cx, cy, mine, box) if len(mine) else None
            if at:
                node = len(axis)
                axis.append(at[0])
                cut.append(at[1])
                child.append([0, 0])
                low = (x0, at[1], y0, y1) if at[0] == 0 else (x0, x1, y0, at[1])
                high = (at[1], x1, y0, y1) if at[0] == 0 else (x0, x1, at[1], y1)
                child[node][0] = grow(low, cands, depth + 1)
                child[node][1] = grow(high, cands, depth + 1)
                return node
        lists.append(cands.astype(np.int32))
        return -len(lists)  # leaf i is -(i + 1)

    top = grow(root, np.arange(k), 0)
    width = max([len(c) for c in lists if len(c) <= _WIDTH], default=1)
    table = np.full((len(lists), width), k, dtype=np.int32)  # k = padding, a centre at infinity
    wide = {}
    for i, c in enumerate(lists):
        if len(c) <= width:
            table[i, : len(c)] = c
        else:
            wide[i] = c
    return {"box": root, "top": top, "axis": np.array(axis, np.int8), "cut": np.array(cut), "child": np.array(child, np.int64).reshape(-1, 2),
            "table": table, "wide": wide}


def _leaves(px, py, cells):
    """The leaf of every point; -1 outside the box."""
    x0, x1, y0, y1 = cells["box"]
    leaf = np.full(len(px), -1, np.int64)
    rows = np.flatnonzero((px >= x0) & (px <= x1) & (py >= y0) & (py <= y1))
    node = np.full(len(rows), cells["top"], np.int64)
    while len(rows):
        done = node < 0
        leaf[rows[done]] = -node[done] - 1
        rows, node = rows[~done], node[~done]
        at = np.where(cells["axis"][node] == 0, px[rows], py[rows])
        node = cells["child"][node, (at > cells["cut"][node]).astype(np.int64)]
    return leaf


def nearest_indices(px: np.ndarray, py: np.ndarray, cx: np.ndarray, cy: np.ndarray, cells=None):
    """Index of the nearest centre (first on ties) and its distance, per point."""
    if cells is None:
        return _nearest(px, py, cx, cy)
    idx = np.empty(len(px), dtype=np.int64)
    best = np.empty(len(px), dtype=np.float64)
    leaf = _leaves(px, py, cells)
    for i in (-1, *cells["wide"]):
        rows = np.flatnonzero(leaf == i)
        if len(rows):
            c = np.arange(len(cx)) if i < 0 else cells["wide"][i]
            j, best[rows] = _nearest(px[rows], py[rows], cx[c], cy[c])
            idx[rows] = c[j]
            leaf[rows] = -2
    table = cells["table"]
    cxa, cya = np.append(cx, np.inf), np.append(cy, np.inf)  # the padding centre is at infinity
    step = max(1, _BLOCK_CELLS // table.shape[1])
    rows = np.flatnonzero(leaf >= 0)
    for start in range(0, len(rows), step):
        pin = rows[start:start + step]
        cand = table[leaf[pin]]
        dx = px[pin, None] - cxa[cand]
        dy = py[pin, None] - cya[cand]
        d = np.sqrt(dx * dx + dy * dy)
        j = d.argmin(axis=1)
        at = np.arange(len(j))
        idx[pin] = cand[at, j]
        best[pin] = d[at, j]
    return idx, best

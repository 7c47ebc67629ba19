"""A direct, single-machine model of the reference program's semantics — test-only.

Points are assigned by a strict ``<`` scan over the ordered centre list starting
from 2147483647; clusters are keyed by centre text, output in byte order of that
text; means truncate toward zero; plain mode skips x = -1 points and keeps a
centre whose x-sum is zero; combined mode keeps a centre without points.
"""

from __future__ import annotations

THRESHOLD = 100


def tdiv(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def nearest(x, y, centers):
    best, best_d = None, 2147483647.0
    for c in centers:
        d = ((x - c[0]) ** 2 + (y - c[1]) ** 2) ** 0.5
        if d < best_d:
            best, best_d = c, d
    if best is None:
        raise ValueError("no centre")
    return best


def step(points, centers, mode):
    groups = {}
    for c in centers:
        groups.setdefault(f"{c[0]},{c[1]}", [])
    for x, y in points:
        c = nearest(x, y, centers)
        groups[f"{c[0]},{c[1]}"].append((x, y))
    out = []
    for key in sorted(groups, key=lambda k: k.encode()):
        ox, oy = (int(v) for v in key.split(","))
        pts = groups[key]
        if mode == "plain":
            inc = [p for p in pts if p[0] != -1]
            sx, sy, n = sum(p[0] for p in inc), sum(p[1] for p in inc), len(inc)
            new = (ox, oy) if sx == 0 else (tdiv(sx, n), tdiv(sy, n))
        else:
            sx, sy, n = sum(p[0] for p in pts), sum(p[1] for p in pts), len(pts)
            new = (ox, oy) if n == 0 else (tdiv(sx, n), tdiv(sy, n))
        out.append((new[0], new[1], ox, oy, len(pts)))
    return out


def moves(rows):
    return [max(abs(r[0] - r[2]), abs(r[1] - r[3])) for r in rows]


def fit(points, centers, iterations, mode, stop="none"):
    its = []
    for r in range(1, iterations + 1):
        rows = step(points, centers, mode)
        its.append(rows)
        centers = [(row[0], row[1]) for row in rows]
        m = moves(rows)
        if stop == "any" and r >= 2 and any(v < THRESHOLD for v in m):
            break
        if stop == "all" and all(v < THRESHOLD for v in m):
            break
    return its


def assignment(points, centers):
    return sorted((nearest(x, y, centers) + (x, y)) for x, y in points)

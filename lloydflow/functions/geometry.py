"""Scalar geometry and text functions on point / centre columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import STABILITY_THRESHOLD


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squared_distance(x: str | Column, y: str | Column, cx: str | Column | int, cy: str | Column | int) -> Column:
    """Squared Euclidean distance as DOUBLE (no 32-bit wrap; exact while below 2**53).

    Assignments compare its root: large squares that differ may have one root, and then the
    lowest rank wins.
    """
    cxc = F.lit(float(cx)) if isinstance(cx, int) else _col(cx).cast("double")
    cyc = F.lit(float(cy)) if isinstance(cy, int) else _col(cy).cast("double")
    dx = _col(x).cast("double") - cxc
    dy = _col(y).cast("double") - cyc
    return dx * dx + dy * dy


def distance(x: str | Column, y: str | Column, cx: str | Column | int, cy: str | Column | int) -> Column:
    """Euclidean distance between a point and a centre, DOUBLE."""
    return F.sqrt(squared_distance(x, y, cx, cy))


def center_text(x: str | Column, y: str | Column) -> Column:
    """centre text ``x,y`` — also the cluster key whose byte order orders all outputs."""
    return F.concat_ws(",", _col(x).cast("string"), _col(y).cast("string"))


def point_text(x: str | Column, y: str | Column) -> Column:
    """point text ``(x,y)``."""
    return F.concat(F.lit("("), _col(x).cast("string"), F.lit(","), _col(y).cast("string"), F.lit(")"))


def movement(new_x: str | Column, new_y: str | Column, old_x: str | Column, old_y: str | Column) -> Column:
    """Largest per-axis move of a centre, BIGINT (no 32-bit wrap)."""
    dx = F.abs(_col(new_x).cast("long") - _col(old_x).cast("long"))
    dy = F.abs(_col(new_y).cast("long") - _col(old_y).cast("long"))
    return F.greatest(dx, dy)


def is_stable(new_x, new_y, old_x, old_y, threshold: int = STABILITY_THRESHOLD) -> Column:
    """F8: a centre is stable iff it moved less than ``threshold`` on both axes."""
    return movement(new_x, new_y, old_x, old_y) < F.lit(threshold)

"""Point sources (S1): text lines ``x,y[,anything]`` or columns of any table.

Text is read with ``spark.read.text`` (split into partitions by Spark, one row
per line) and parsed with built-in expressions only, so the parse runs inside
whole-stage codegen.  The first two comma fields are the coordinates; further
fields are ignored; anything the reference's ``Integer.parseInt`` rejects fails
the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import field, strict_int

POINT_SCHEMA = "x INT, y INT"


def parse_point_lines(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a column of point lines into ``x, y`` INT (plus the ``keep`` columns).

    Only commas separate fields here (a tab is not a separator for points).
    """
    parts = F.split(F.col(line_col), ",")
    return lines.select(
        *keep,
        strict_int(field(parts, 0), "point x").alias("x"),
        strict_int(field(parts, 1), "point y").alias("y"),
    )


def read_points(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read a file, directory or glob of point lines."""
    return parse_point_lines(spark.read.text(path))


def points_from(df: DataFrame, x: str | Column, y: str | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project any table to ``x, y`` INT points.

    A NULL or out-of-32-bit-range coordinate fails the query whatever the
    session's ANSI setting (no silent wrap-around).
    """
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    checked = []
    for name, c in (("x", xc), ("y", yc)):
        bad = c.isNull() | (c < F.lit(-2147483648)) | (c > F.lit(2147483647))
        checked.append(
            F.when(bad, F.raise_error(F.lit(f"point {name} is NULL or outside the 32-bit range")).cast("int"))
            .otherwise(c.cast("int"))
            .alias(name)
        )
    return df.select(*keep, *checked)


def collapse_points(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Collapse equal points to ``(x, y, weight)`` — exact for every later sum.

    Worth it for very repetitive integer data: the collapse is one partially
    aggregated shuffle (hot points are combined map-side), after which every
    iteration touches only distinct points.
    """
    return points.groupBy(x, y).agg(F.count(F.lit(1)).alias("weight"))


def parse_assignment_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """S8 read-back: ``cx,cy<TAB>x,y `` lines → ``center_x, center_y, x, y``."""
    body = F.regexp_replace(F.col(line_col), " $", "")
    parts = F.split(F.translate(body, "\t", ","), ",")
    names = ("center_x", "center_y", "x", "y")
    return lines.select(*[strict_int(field(parts, i), f"listing {n}").alias(n) for i, n in enumerate(names)])


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Read a point listing written by ``write_assignments``."""
    return parse_assignment_lines(spark.read.text(path))

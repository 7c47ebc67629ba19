"""Sinks (S6, S7, S8, S9) in the reference's text layouts, plus parquet.

Result and status files hold one line per centre, sorted by the old centre's text over
as many range-partitioned part files as their size asks for; the loop's own short lists
make one.  The assignment listing holds one line per point; its parts follow the
order of the centre texts and their sizes: small centres share a part, a large
one is spread over several.
Existing output paths fail the write, as the reference's output format does
(``mode="overwrite"`` replaces them; a resumed run uses it for unfinished rounds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import IN_PLAN_CENTERS, STATUS_CONVERGED, STATUS_NOT_CONVERGED
from ..functions.geometry import center_text
from ..operators.ordering import running_totals
from ..operators.uneven import join_by_size
from ..session import local_frame


def iteration_path(prefix: str, iteration: int | str) -> str:
    """The reference's output naming — prefix + iteration number, or prefix + ``Final``."""
    return f"{prefix}{iteration}"


def result_lines(result: DataFrame) -> DataFrame:
    """``newX,newY<TAB>oldX,oldY`` with the old-centre text as sort key."""
    return result.select(
        center_text("old_x", "old_y").alias("key"),
        F.concat_ws("\t", center_text("new_x", "new_y"), center_text("old_x", "old_y")).alias("value"),
    )


def _ordered(df: DataFrame, *keys, short: bool = False) -> DataFrame:
    """The rows sorted over range partitions; a list known to be ``short`` in one part."""
    out = df.orderBy(*keys)
    return out.coalesce(1) if short else out


def write_result(result: DataFrame, path: str, fmt: str = "text", mode: str = "errorifexists", short: bool = False) -> None:
    """One iteration's ``(new, old)`` rows ordered by old-centre text (the order goes on from part to part)."""
    if fmt == "parquet":
        _ordered(result, center_text("old_x", "old_y"), short=short).write.mode(mode).parquet(path)
        return
    _ordered(result_lines(result), "key", short=short).select("value").write.mode(mode).text(path)


def status_lines(result: DataFrame, status: str) -> DataFrame:
    """S7 lines: the status, then the new centres in old-centre text order."""
    if status not in (STATUS_CONVERGED, STATUS_NOT_CONVERGED):
        raise ValueError(f"unknown status {status!r}")
    spark = result.sparkSession
    head = local_frame(spark, [(0, "", status)], "part INT, key STRING, value STRING")
    body = result.select(
        F.lit(1).alias("part"), center_text("old_x", "old_y").alias("key"), center_text("new_x", "new_y").alias("value")
    )
    return head.unionByName(body)


def write_status(result: DataFrame, status: str, path: str, mode: str = "errorifexists", short: bool = False) -> None:
    """Status-headed centre file (the old centres are dropped); of several parts the first has the status."""
    _ordered(status_lines(result, status), "part", "key", short=short).select("value").write.mode(mode).text(path)


def assignment_lines(assigned: DataFrame) -> DataFrame:
    """S8 lines ``cx,cy<TAB>x,y `` (trailing blank, as the reference writes)."""
    return assigned.select(
        center_text("center_x", "center_y").alias("key"),
        "x", "y",
        F.concat(center_text("center_x", "center_y"), F.lit("\t"), center_text("x", "y"), F.lit(" ")).alias("value"),
    )


#: Listing lines per part.
PART_ROWS = 4_000_000


def _parts(before, n):
    """First part and number of parts of a centre with ``n`` lines and ``before`` lines ahead of it."""
    return F.floor(before / F.lit(PART_ROWS)).cast("int"), F.greatest(F.lit(1), F.ceil(n / F.lit(PART_ROWS))).cast("int")


def _deal(spark, key: str, sizes) -> tuple[DataFrame, int]:
    """(key, __points, __first, __parts) per centre, in the order of the centre texts; and the number of parts.

    Lines are counted through in that order and a part takes ``PART_ROWS`` of them, so small
    centres share parts and a centre larger than a part has its own share of several.
    """
    if isinstance(sizes, DataFrame):
        texts = sizes.select(center_text("x", "y").alias(key), F.col("points").cast("long").alias("__points"))
        counted = running_totals(texts, [key], "__points", "__before")
    else:
        rows, before = [], 0
        for text, n in sorted((f"{x},{y}", int(n)) for x, y, n in sizes):
            rows.append((text, n, before))
            before += n
        counted = local_frame(spark, rows, f"{key} STRING, __points BIGINT, __before BIGINT")
    first, parts = _parts(F.col("__before"), F.col("__points"))
    plan = counted.select(key, "__points", first.alias("__first"), parts.alias("__parts"))
    return plan, plan.agg(F.max(F.col("__first") + F.col("__parts"))).first()[0] or 1


def _sorted(df: DataFrame, key: str, sizes) -> DataFrame:
    """The listing's rows in parts that follow the centres' text order, sorted within each part.

    ``sizes`` gives the (rough) number of points per centre: ``(x, y, points)`` tuples, or a
    DataFrame of those columns for any number of centres.  Parts are dealt from it without a
    sampling pass over the points.  The lines of a centre of several parts go to them by row id, so
    neither a large cluster nor one repeated point makes a large part.
    """
    plan, n = _deal(df.sparkSession, key, sizes)
    # A short plan is a local relation, which the planner broadcasts by itself.
    dealt = join_by_size(df, plan, key, "__points", PART_ROWS) if isinstance(sizes, DataFrame) else df.join(plan, key)
    part = F.col("__first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__parts")).cast("int")
    return (dealt.withColumn("__part", part).repartitionById(n, F.col("__part"))
            .sortWithinPartitions("__part", key, "x", "y").select(*df.columns))


def _counted(assigned: DataFrame):
    """Points per centre: a list if there are few centres, else a table."""
    counts = assigned.groupBy(F.col("center_x").alias("x"), F.col("center_y").alias("y")).agg(F.count(F.lit(1)).alias("points"))
    rows = counts.limit(IN_PLAN_CENTERS + 1).collect()
    return counts if len(rows) > IN_PLAN_CENTERS else [tuple(r) for r in rows]


def write_assignments(assigned: DataFrame, path: str, fmt: str = "text", sort: bool = True,
                      mode: str = "errorifexists", sizes=None) -> None:
    """The point → centre listing, in the order of the centre texts when ``sort``.

    ``sizes`` (``(x, y, points)`` per centre, as tuples or as a DataFrame) spares the count of
    the points per centre; it sizes the parts and must name every centre.
    """
    if sort and sizes is None:
        sizes = _counted(assigned)
    sort = sort and (isinstance(sizes, DataFrame) or bool(sizes))
    if fmt == "parquet":
        out = assigned.select(center_text("center_x", "center_y").alias("__key"), "center_x", "center_y", "x", "y")
        if sort:
            out = _sorted(out, "__key", sizes)
        out.drop("__key").write.mode(mode).parquet(path)
        return
    lines = assignment_lines(assigned)
    if sort:
        lines = _sorted(lines, "key", sizes)
    lines.select("value").write.mode(mode).text(path)

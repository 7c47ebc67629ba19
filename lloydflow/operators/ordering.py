"""Ordering by centre text (O1), row numbers and running totals in an order (O2).

The reference's outputs follow the byte order of the ``x,y`` text (its shuffle
key), and the next iteration's centre order is that output order.  Spark's
string order is the same unsigned byte order.

Numbers over a whole table never come from one window over all rows: the rows are
sorted in range partitions and written, each is numbered in its partition, and
the counts of the partitions before it (one row a partition) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import center_text
from ..session import local_frame, written

_AT, _PART, _SHIFT = "__at", "__part", "__shift"


def order_by_center_text(df: DataFrame, x: str = "old_x", y: str = "old_y") -> DataFrame:
    """O1: sort rows by the centre text ``x,y`` (range-partitioned global sort)."""
    return df.orderBy(center_text(x, y))


def _in_ranges(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows in sorted range partitions, written with their partition and place (``partition << 33 | place``)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn(_AT, F.monotonically_increasing_id()), name)


def _part() -> Column:
    return F.shiftright(_AT, 33).cast("int")


def _shifted(rows: DataFrame, amount: Column) -> DataFrame:
    """The rows with ``_SHIFT``: the total of ``amount`` over all partitions before their own."""
    shifts, total = [], 0
    # One row per partition of the job that wrote the rows.
    for part, n in sorted((r[0], int(r[1] or 0)) for r in rows.groupBy(_part()).agg(F.sum(amount)).collect()):
        shifts.append((part, total))
        total += n
    parts = local_frame(rows.sparkSession, shifts, f"{_PART} INT, {_SHIFT} BIGINT")
    return rows.withColumn(_PART, _part()).join(F.broadcast(parts), _PART)


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """Add ``name``: the 0-based place (BIGINT) of each row in ``order`` over the whole table."""
    shifted = _shifted(_in_ranges(df, order, "numbered"), F.lit(1))
    place = F.col(_SHIFT) + F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return shifted.withColumn(name, place).drop(_AT, _PART, _SHIFT)


def running_totals(df: DataFrame, order: Sequence[str | Column], amount: str, name: str = "before") -> DataFrame:
    """Add ``name``: the total of ``amount`` (BIGINT, not null) over all rows before this one in ``order``."""
    shifted = _shifted(_in_ranges(df, order, "totals"), F.col(amount))
    # A range partition is one window: its rows are an equal share of the table.
    here = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col(_SHIFT) + F.coalesce(F.sum(amount).over(here), F.lit(0))
    return shifted.withColumn(name, total.cast("long")).drop(_AT, _PART, _SHIFT)


def rank_by_center_text(result: DataFrame, x: str = "old_x", y: str = "old_y", name: str = "pos") -> DataFrame:
    """O2: 0-based position of each row in centre-text order (any number of rows)."""
    return number_rows(result, [center_text(x, y)], name).withColumn(name, F.col(name).cast("int"))


def text_key(x: int, y: int) -> bytes:
    """The same order on the driver, for collected centre rows."""
    return f"{int(x)},{int(y)}".encode()

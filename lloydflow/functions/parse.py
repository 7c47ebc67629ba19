"""Strict text-to-integer parsing and delimiter handling.

The reference parses with ``Integer.parseInt``: an optional sign and ASCII
digits, nothing else, within 32 bits.  Spark's ANSI cast alone accepts
surrounding blanks, so the pattern is checked first and a bad field fails the
query through ``raise_error`` instead of turning into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted integer syntax of the reference's parser.
INT_PATTERN = r"^[+-]?[0-9]+$"


def strict_int(field: Column, what: str) -> Column:
    """Parse one text field as INT or fail the query (NULL, blank, float, overflow).

    The range is checked explicitly, so the result does not depend on the
    session's ANSI setting: leading zeros are dropped (as ``parseInt`` allows any
    number of them), at most ten digits remain, and the value is compared as
    BIGINT against the 32-bit bounds.
    """
    trimmed = F.regexp_replace(field, r"^([+-]?)0+(?=[0-9])", "$1")
    digits = F.regexp_replace(trimmed, r"^[+-]", "")
    wide = F.when(F.length(digits) <= 10, trimmed.cast("long"))
    ok = (field.isNotNull() & field.rlike(INT_PATTERN) & wide.isNotNull()
          & wide.between(-2147483648, 2147483647))
    msg = F.concat(F.lit(f"invalid {what}: '"), F.coalesce(field, F.lit("<missing>")), F.lit("'"))
    return F.when(ok, wide.cast("int")).otherwise(F.raise_error(msg).cast("int"))


def fields(line: Column) -> Column:
    """Split a line into comma fields after turning tabs into commas."""
    return F.split(F.translate(line, "\t", ","), ",")


def field(parts: Column, i: int) -> Column:
    """0-based field access; a missing field is NULL (and then fails ``strict_int``)."""
    return F.get(parts, i)

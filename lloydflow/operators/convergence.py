"""Movement, stability reductions and the status message.

These run over an iteration result — one row per centre — so they are tiny
aggregates; the fit loop evaluates the same rules on the rows it already holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import STABILITY_THRESHOLD, STATUS_CONVERGED, STATUS_NOT_CONVERGED
from ..functions.geometry import movement


def with_movement(result: DataFrame, threshold: int = STABILITY_THRESHOLD) -> DataFrame:
    """F8: add ``move`` (largest per-axis move) and ``stable`` (move < threshold)."""
    m = movement("new_x", "new_y", "old_x", "old_y")
    return result.withColumn("move", m).withColumn("stable", F.col("move") < F.lit(threshold))


def any_stable(result: DataFrame, threshold: int = STABILITY_THRESHOLD) -> DataFrame:
    """True when at least one centre is stable — the stop-on-first-stable test."""
    return with_movement(result, threshold).agg(F.bool_or("stable").alias("any_stable"))


def all_stable(result: DataFrame, threshold: int = STABILITY_THRESHOLD) -> DataFrame:
    """True when every centre is stable — the stop-when-all-stable test."""
    return with_movement(result, threshold).agg(F.bool_and("stable").alias("all_stable"))


def status_message(result: DataFrame, threshold: int = STABILITY_THRESHOLD) -> DataFrame:
    """``Has converged`` when every centre is stable, else ``Has not converged``."""
    return with_movement(result, threshold).agg(
        F.when(F.bool_and("stable"), F.lit(STATUS_CONVERGED)).otherwise(F.lit(STATUS_NOT_CONVERGED)).alias("status")
    )


def status_of(moves: list[int], threshold: int = STABILITY_THRESHOLD) -> str:
    """A8 on the driver, for rows already collected by the fit loop."""
    return STATUS_CONVERGED if all(m < threshold for m in moves) else STATUS_NOT_CONVERGED

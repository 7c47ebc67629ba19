"""Run report (I8): the reference prints elapsed seconds; we keep a per-iteration history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .lloyd import FitResult


def history(fit_result: FitResult) -> DataFrame:
    """Per iteration: k, assigned points, largest move, stable centres, status, seconds."""
    return fit_result.history()


def elapsed_seconds(fit_result: FitResult) -> float:
    """Total seconds spent in the iterations (the figure the reference prints)."""
    return sum(it.seconds for it in fit_result.iterations)


def summary(fit_result: FitResult) -> str:
    last = fit_result.iterations[-1]
    return (f"{fit_result.iterations_run} iteration(s), mode={fit_result.mode}, stop={fit_result.stop}, "
            f"k={len(last.rows)}, {last.status}, {elapsed_seconds(fit_result):.3f} seconds")

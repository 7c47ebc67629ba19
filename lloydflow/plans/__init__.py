"""Iterative plans (Lloyd step, fit loop, run report) and the named query catalog."""

from .large import TableFitResult
from .lloyd import FitResult, Iteration, fit, prepare_centers, step
from .report import elapsed_seconds, history, summary

__all__ = ["FitResult", "Iteration", "TableFitResult", "elapsed_seconds", "fit", "history", "prepare_centers", "step", "summary"]

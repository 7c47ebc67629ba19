"""lloydflow — Lloyd (k-means) clustering of 2-D integer points on Spark DataFrames.

Layout:
  functions/  column expressions (distance, text forms, partial averages, parsing)
  sources/    point / centre / result readers, JSON exchange, text and parquet sinks
  operators/  nearest-centre assignment, cluster aggregation, convergence, ordering
  plans/      one Lloyd step, the iteration loop with its stop rules, run report, query catalog
  streaming/  the same assignment and cluster statistics over streaming DataFrames
  cli.py      the six program variants as one command line
"""

from .functions import center_text, distance, point_text
from .operators import (
    all_stable,
    any_stable,
    assign,
    cluster_stats,
    members,
    merge_partials,
    partials,
    status_message,
    with_movement,
)
from .plans import FitResult, fit, prepare_centers, step
from .sources import (
    centers_from_json,
    centers_to_json,
    collapse_points,
    points_from,
    read_assignments,
    read_centers,
    read_points,
    read_result,
    read_status_centers,
    write_assignments,
    write_result,
    write_status,
)

__all__ = [
    "FitResult", "all_stable", "any_stable", "assign", "center_text", "centers_from_json", "centers_to_json",
    "cluster_stats", "collapse_points", "distance", "fit", "members", "merge_partials", "partials", "point_text",
    "points_from", "prepare_centers", "read_assignments", "read_centers", "read_points", "read_result",
    "read_status_centers", "status_message", "step",
    "with_movement", "write_assignments", "write_result", "write_status",
]

"""Sources and sinks: point text / tables, centre files, results, JSON exchange."""

from .centers import (
    as_center_list,
    centers_frame,
    centers_from_json,
    centers_to_json,
    collapse_centers,
    next_centers,
    parse_center_lines,
    parse_result_lines,
    parse_status_lines,
    ranked_distinct,
    read_centers,
    read_centers_json,
    read_result,
    read_status_centers,
    to_json_text,
    write_centers_json,
)
from .points import (
    collapse_points,
    parse_assignment_lines,
    parse_point_lines,
    points_from,
    read_assignments,
    read_points,
)
from .sinks import (
    assignment_lines,
    iteration_path,
    result_lines,
    status_lines,
    write_assignments,
    write_result,
    write_status,
)

__all__ = [
    "as_center_list", "assignment_lines", "centers_frame", "centers_from_json", "centers_to_json",
    "collapse_centers", "collapse_points", "iteration_path", "parse_assignment_lines", "read_assignments", "next_centers", "parse_center_lines",
    "parse_point_lines", "parse_result_lines", "parse_status_lines", "points_from", "ranked_distinct",
    "read_centers", "read_centers_json", "read_points", "read_result", "read_status_centers", "result_lines", "status_lines",
    "to_json_text", "write_assignments", "write_centers_json", "write_result", "write_status",
]

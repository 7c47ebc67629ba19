"""Column-level functions: geometry, text forms, partial averages, strict parsing."""

from .average import (
    keep_old,
    keep_or_move,
    merge_partials_agg,
    partials_equal,
    point_partial,
    seed_partial,
    sentinel_included,
    truncated_mean,
)
from .constants import (
    STABILITY_THRESHOLD,
    STATUS_CONVERGED,
    STATUS_NOT_CONVERGED,
    UNROLL_LIMIT,
)
from .geometry import center_text, distance, is_stable, movement, point_text, squared_distance
from .parse import strict_int

__all__ = [
    "STABILITY_THRESHOLD", "STATUS_CONVERGED", "STATUS_NOT_CONVERGED",
    "UNROLL_LIMIT", "center_text", "distance", "is_stable", "keep_old", "keep_or_move",
    "merge_partials_agg", "movement", "partials_equal", "point_partial", "point_text", "seed_partial",
    "sentinel_included", "squared_distance", "strict_int", "truncated_mean",
]

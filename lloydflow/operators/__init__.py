"""Relational operators: assignment, aggregation, convergence, ordering."""

from .aggregate import (
    apply_stats,
    cluster_stats,
    finalize_partials,
    finalize_stats,
    members,
    merge_partials,
    partials,
    seeded_stats,
    seeds,
)
from .assign import assign, assign_rank, choose_strategy
from .convergence import all_stable, any_stable, status_message, status_of, with_movement
from .ordering import number_rows, order_by_center_text, rank_by_center_text, running_totals, text_key
from .tiles import TileIndex, assign_table, build_index, nearest_table, stats_table
from .uneven import join_by_size

__all__ = [
    "TileIndex", "assign_table", "build_index", "join_by_size", "nearest_table", "number_rows", "running_totals", "stats_table",
    "all_stable", "any_stable", "apply_stats", "assign", "assign_rank", "choose_strategy", "cluster_stats",
    "finalize_partials", "finalize_stats", "members", "merge_partials", "order_by_center_text", "partials",
    "rank_by_center_text", "seeded_stats", "seeds", "status_message", "status_of", "text_key", "with_movement",
]

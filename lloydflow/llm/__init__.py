"""Operators for preparing training data at scale; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

from .ann_tree import op7_ann_tree
from .fim import OP11_SQL, op11_fill_in_middle
from .importance import OP13_SQL, op13_importance_resampling
from .jaccard_join import OP10_SQL, op10_jaccard_join
from .katz import op1_katz_lm
from .lang_id import op5_language_id
from .line_dedup import OP4_SQL, op4_line_dedup
from .mixing import op2_entropy_mix
from .packing import op9_best_fit_packing
from .pfor import op8_pfor_tokens
from .quality import op12_quality_rules
from .secret_scan import op3_secret_scan
from .topk_exact import OP6_SQL, op6_exact_topk

# Executors need no installed copy of the package: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def queries() -> dict:
    """One query per operator over its whole table."""
    return {f.__name__: f for f in (
        op1_katz_lm, op2_entropy_mix, op3_secret_scan, op4_line_dedup, op5_language_id, op6_exact_topk, op7_ann_tree,
        op8_pfor_tokens, op9_best_fit_packing, op10_jaccard_join, op11_fill_in_middle, op12_quality_rules, op13_importance_resampling)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op4_line_dedup": OP4_SQL, "op6_exact_topk": OP6_SQL, "op10_jaccard_join": OP10_SQL, "op11_fill_in_middle": OP11_SQL,
            "op13_importance_resampling": OP13_SQL}

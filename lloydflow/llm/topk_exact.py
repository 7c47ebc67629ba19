"""Exact top-k inner products by columnar branch and bound.

Candidates lie in vertical layout.  For a query, partial inner products are
accumulated dimension block by dimension block; by Cauchy-Schwarz the part that
is still missing is at most |rest of the query| * |rest of the candidate|.  A
candidate whose upper bound is below the k-th best lower bound can't be among
the best and leaves; the survivors are compacted before the next block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .vectors import best, blocks, every_pair, usable

#: Vectors in a block of queries and of candidates; dimensions accumulated between prunings.
QUERY_ROWS, CANDIDATE_ROWS, DIM_STEP = 1024, 4096, 16


def branch_and_bound(q: np.ndarray, x: np.ndarray, rests: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns of x, scores) of at least the k best for one query; ties at the k-th place are all kept.

    ``rests[b]`` holds the candidates' norms over the dimensions from ``b * DIM_STEP`` on;
    ``skip`` marks columns that are no candidates.
    """
    alive = np.flatnonzero(~skip)
    partial = np.zeros(len(alive))
    dims = len(q)
    for b, at in enumerate(range(0, dims, DIM_STEP)):
        partial = partial + q[at:at + DIM_STEP] @ x[at:at + DIM_STEP, alive]
        if at + DIM_STEP >= dims or len(alive) <= k:
            continue
        # The slack covers rounding; the integers themselves are exact in doubles.
        missing = np.sqrt((q[at + DIM_STEP:] ** 2).sum()) * rests[b + 1][alive] * (1 + 1e-9) + 1e-6
        floor = np.partition(partial - missing, len(alive) - k)[len(alive) - k]
        stay = partial + missing >= floor
        alive, partial = alive[stay], partial[stay]
    if len(alive) > k:
        stay = partial >= np.partition(partial, len(alive) - k)[len(alive) - k]
        alive, partial = alive[stay], partial[stay]
    return alive, partial


def _align(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dims = max(len(q), len(x))
    return tuple(np.vstack([m, np.zeros((dims - len(m), m.shape[1]))]) for m in (q, x))


def exact_topk(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest integer inner products of each query.

    Components become ``floor(scale * x)``.  Queries are the rows whose vec_id is
    divisible by ``every``; candidates all rows with another vec_id.  Ties go to the
    smaller vec_id.  Vectors that are null or hold null or non-finite components
    take no part, nor do rows without a vec_id; a missing component of a shorter
    vector counts 0.  Rows that repeat a vec_id are candidates (and queries) each for
    themselves.  An empty table gives no rows.  Scores are exact while their absolute partial sums
    fit a long; from 2^53 on they are summed in extended precision.
    """
    whole = usable(vectors).withColumn(
        "embedding", F.transform("embedding", lambda x: F.floor(x * scale).cast("double")))
    candidates = blocks(whole, CANDIDATE_ROWS, "cb")
    asked = whole.filter(F.col("vec_id") % every == 0)
    queries = blocks(asked.repartition(max(1, -(-asked.count() // QUERY_ROWS))), QUERY_ROWS, "qb")

    def match(qs, cs) -> pd.DataFrame:
        (q_ids, q), (c_ids, c) = qs, cs
        q, c = _align(q, c)
        square = c ** 2
        rests = [np.sqrt(square[at:].sum(axis=0)) for at in range(0, max(len(c), 1), DIM_STEP)]
        # Sums that doubles may not hold exactly are taken in the wider type, without pruning.
        wide = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * len(c) >= 2 ** 53
        out = []
        for j, qid in enumerate(q_ids):
            if wide:
                cols = np.flatnonzero(c_ids != qid)
                scores = q[:, j].astype(np.longdouble) @ c[:, cols].astype(np.longdouble)
            else:
                cols, scores = branch_and_bound(q[:, j], c, rests, k, c_ids == qid)
            order = np.lexsort((c_ids[cols], -scores))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": c_ids[cols][order], "score": scores[order].astype(np.int64)}))
        return pd.concat(out)

    found = every_pair(queries, candidates, match, "query_id long, vec_id long, score long")
    return best(found, k)


def op6_exact_topk(spark, sf_dir) -> DataFrame:
    """The ten best matches of every hundredth embedding."""
    return exact_topk(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

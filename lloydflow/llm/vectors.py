"""Vectors for the searches: which rows take part, and packed blocks of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dense, stored


def usable(df: DataFrame, zero: bool = True) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part.

    Null vectors and vectors with a null or non-finite component take none, nor do
    rows without a vec_id; with ``zero=False`` all-zero (and empty) vectors are left out too.
    """
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = df.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return out if zero else out.filter(F.exists("embedding", lambda x: x != 0))


def padded(vectors: list, dim: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    dim = max([dim or 0, *map(len, vectors)])
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def blocks(df: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """Written table (<name>, ids, dims, data) of at most ``rows`` vectors a row, keyed 0, 1, 2, ...; and its rows.

    ``data`` is the vertical layout: all first components, all second ones, and so on.
    """
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, len(batch), rows):
                ids = batch["vec_id"].iloc[at:at + rows].to_numpy(np.int64)
                m = padded(batch["embedding"].iloc[at:at + rows].tolist())
                yield pd.DataFrame({"_mid": [(part << 33) + seq], "ids": [ids.tobytes()], "dims": [m.shape[1]],
                                    "data": [np.ascontiguousarray(m.T).tobytes()]})
                seq += 1

    made = df.select("vec_id", "embedding").mapInPandas(make, "_mid long, ids binary, dims int, data binary")
    return dense(stored(made, name), "_mid", name)


def unblock(row) -> tuple[np.ndarray, np.ndarray]:
    """(ids, components as dims x vectors) of one block."""
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], np.float64).reshape(int(row["dims"]), len(ids))


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def every_pair(queries: tuple[DataFrame, int], candidates: tuple[DataFrame, int], match, schema: str) -> DataFrame:
    """``match(query block, candidate block) -> DataFrame`` on every pair of blocks.

    ``queries`` are blocks keyed ``qb``, ``candidates`` blocks keyed ``cb``.  A block is sent
    once per block of the other side and met there by the key (cb, qb), so a task
    holds two blocks at a time whatever the table sizes.
    """
    (q, n_q), (c, n_c) = queries, candidates
    if not n_q or not n_c:
        return q.sparkSession.createDataFrame([], schema)
    left = c.withColumn("qb", F.explode(F.expr(f"sequence(0L, {n_q - 1}L)")))
    right = q.withColumn("cb", F.explode(F.expr(f"sequence(0L, {n_c - 1}L)")))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([match(unblock(x), unblock(y)) for _, y in a.iterrows() for _, x in b.iterrows()])

    return left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInPandas(meet, schema)

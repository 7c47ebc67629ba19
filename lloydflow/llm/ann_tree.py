"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first.

The tree is fitted on a bounded sample on the driver and every row is put into a
leaf.  A query walks the tree through a priority queue of nodes, ordered by the
inner product with their centres, and visits leaves until it has seen as many as
calibration asks for and they hold k candidates, if there are as many.  Calibration
takes a bounded set of queries for each size class of leaves, finds their true
neighbours among all rows and widens the visits of the class until the target share
of its queries find the target share of theirs in visited leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .vectors import best, padded, usable

#: Vectors the tree is fitted on; its fan-out; sample vectors in a leaf at most.
SAMPLE, BRANCH, LEAF = 20_000, 8, 64
#: Queries of a size class of leaves that set its number of visits, and the recall asked of them.
CALIBRATION, RECALL = 96, 0.97
#: Members of a leaf, and queries at a leaf, that meet in one group at most.
MEMBERS, QUERIES = 2048, 1024


@dataclass
class Node:
    centres: np.ndarray  # children x dims
    children: list = field(default_factory=list)  # Node, or the number of a leaf


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Group of each row; Lloyd steps from distinct random rows."""
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(12):
        group = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, x)
        n = np.bincount(group, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return _nearest(x, centres)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def fit_tree(sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 7) -> tuple[Node, int]:
    """The tree over ``sample`` and its number of leaves."""
    rng, n_leaves = np.random.default_rng(seed), 0

    def grow(x: np.ndarray):
        nonlocal n_leaves
        if len(x) > leaf:
            group = _kmeans(x, branch, rng)
            kinds = np.unique(group)
            if len(kinds) > 1:
                return Node(np.array([x[group == g].mean(axis=0) for g in kinds]), [grow(x[group == g]) for g in kinds])
        n_leaves += 1
        return n_leaves - 1

    top = grow(sample)
    if not isinstance(top, Node):
        top = Node(sample.mean(axis=0, keepdims=True) if len(sample) else np.zeros((1, sample.shape[1])), [top])
    return top, n_leaves


def leaf_of(x: np.ndarray, node: Node) -> np.ndarray:
    """The leaf of each row: down the nearest centres."""
    out, group = np.zeros(len(x), np.int64), _nearest(x, node.centres)
    for g, child in enumerate(node.children):
        mine = group == g
        if mine.any():
            out[mine] = leaf_of(x[mine], child) if isinstance(child, Node) else child
    return out


def leaves_in_order(q: np.ndarray, root: Node, visits: int, counts: dict[int, int] | None = None, least: int = 0) -> list[int]:
    """Best-bin-first: the first ``visits`` leaves that the queue yields, and further ones until they hold ``least`` rows."""
    heap, tie, out, held = [(0.0, 0, root)], 0, [], 0
    while heap and (len(out) < visits or held < least):
        _, _, node = heapq.heappop(heap)
        if not isinstance(node, Node):
            out.append(node)
            held += counts.get(node, 0) if counts else 0
            continue
        for worth, child in zip((node.centres @ q).tolist(), node.children):
            tie += 1
            heapq.heappush(heap, (-worth, tie, child))
    return out


def size_class(rows: int) -> int:
    """Class of a leaf by its rows: powers of eight."""
    return rows.bit_length() // 3


def quantile(values: list[int], share: float) -> int:
    """The least value that the share of the values do not exceed."""
    return sorted(values)[min(len(values), int(np.ceil(share * len(values)))) - 1]


def _top(q: np.ndarray, x: np.ndarray, ids: np.ndarray, qid: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of x.

    The product with all rows only preselects; scores are summed row by row, so
    equal vectors get equal scores wherever they stand.
    """
    rough = x @ q
    rough[ids == qid] = -np.inf
    if len(rough) > k:
        slack = 1e-9 * (1 + np.abs(rough[np.isfinite(rough)]).max(initial=0))
        near = np.flatnonzero(rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack)
    else:
        near = np.arange(len(rough))
    near = near[ids[near] != qid]
    scores = (x[near] * q).sum(axis=1)
    order = np.lexsort((ids[near], -scores))[:k]
    return ids[near][order], scores[order]


def ann_topk(vectors: DataFrame, k: int = 20, every: int = 20, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k nearest found, by inner product.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows with
    another vec_id.  Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without a vec_id; a missing component of a
    shorter vector counts 0.  Rows that repeat a vec_id take part each for
    themselves.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, zero=False)
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()  # bounded by ``sample``
    if not len(first):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0]
    tree, n_leaves = fit_tree(padded(first["embedding"].tolist(), dims))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = padded(b["embedding"].tolist(), dims)
            yield pd.DataFrame({"vec_id": b["vec_id"], "leaf": leaf_of(x, tree), "v": [r.tobytes() for r in x]})

    index = stored(rows.mapInPandas(place, "vec_id long, leaf long, v binary"), "leaves")

    counts = {r[0]: r[1] for r in index.groupBy("leaf").count().collect()}  # at most n_leaves rows
    classes = spark.createDataFrame([(n, size_class(c)) for n, c in counts.items()], "leaf long, class int")
    asked = index.filter(F.col("vec_id") % every == 0).join(F.broadcast(classes), "leaf")

    # Calibration: the true neighbours of a bounded set of queries of each class, over all rows.
    few_pd = pd.concat([asked.filter(F.col("class") == c).orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(CALIBRATION).toPandas()
                        for c in sorted({size_class(c) for c in counts.values()})]).drop_duplicates("vec_id")
    if not len(few_pd):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    q_ids, q_rows = few_pd["vec_id"].to_numpy(np.int64), np.frombuffer(b"".join(few_pd["v"]), np.float64).reshape(len(few_pd), dims)

    def truth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.frombuffer(b"".join(b["v"]), np.float64).reshape(len(b), dims)
            ids, leaf = b["vec_id"].to_numpy(np.int64), dict(zip(b["vec_id"], b["leaf"]))
            for qid, q in zip(q_ids, q_rows):
                got, scores = _top(q, x, ids, qid, k)
                yield pd.DataFrame({"query_id": qid, "vec_id": got, "score": scores, "leaf": [leaf[i] for i in got]})

    true = best_with_leaf(index.mapInPandas(truth, "query_id long, vec_id long, score double, leaf long"), k)
    places = {int(qid): {leaf: i for i, leaf in enumerate(leaves_in_order(q, tree, n_leaves))} for qid, q in zip(q_ids, q_rows)}
    # At most CALIBRATION * k rows a class.
    depth = {int(qid): [] for qid in q_ids}
    for r in true.collect():
        depth[r["query_id"]].append(places[r["query_id"]][r["leaf"]] + 1)
    needs = {}
    for qid, c in zip(q_ids.tolist(), few_pd["class"].tolist()):
        needs.setdefault(c, []).append(quantile(depth[qid], recall) if depth[qid] else 1)
    visits = {c: quantile(x, recall) for c, x in needs.items()}

    # Rows of a query's own vec_id are no candidates of it.
    repeated = stored(asked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own")).filter("own > 1"), "repeated", light=True)
    asked = asked.join(repeated, "vec_id", "left").select("vec_id", "v", "class", F.coalesce("own", F.lit(1)).alias("own"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for qid, v, c, own in zip(b["vec_id"].tolist(), b["v"], b["class"].tolist(), b["own"].tolist()):
                leaves = [n for n in leaves_in_order(np.frombuffer(v, np.float64), tree, visits[c], counts, k + own) if n in counts]
                yield pd.DataFrame({"query_id": qid, "leaf": leaves, "q": [v] * len(leaves)})

    # Hot leaves are dealt in chunks; the chunks of a leaf meet its queries each.
    asks = stored(asked.mapInPandas(walk, "query_id long, leaf long, q binary"), "visits")
    wanted = {r[0]: r[1] for r in asks.groupBy("leaf").count().collect()}  # at most n_leaves rows
    deals = spark.createDataFrame(
        [(n, -(-counts[n] // MEMBERS), -(-wanted[n] // QUERIES)) for n in wanted], "leaf long, chunks int, groups int")
    members = (index.join(F.broadcast(deals), "leaf")
               .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")))
               .withColumn("grp", F.explode(F.expr("sequence(0L, CAST(groups - 1 AS BIGINT))"))).drop("chunks", "groups"))
    visitors = (asks.join(F.broadcast(deals), "leaf")
                .withColumn("grp", F.pmod(F.xxhash64("query_id"), F.col("groups")))
                .withColumn("chunk", F.explode(F.expr("sequence(0L, CAST(chunks - 1 AS BIGINT))"))).drop("chunks", "groups"))

    def search(m: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(m) or not len(v):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x = np.frombuffer(b"".join(m["v"]), np.float64).reshape(len(m), dims)
        ids = m["vec_id"].to_numpy(np.int64)
        out = []
        for qid, q in zip(v["query_id"].tolist(), v["q"]):
            got, scores = _top(np.frombuffer(q, np.float64), x, ids, qid, k)
            out.append((np.full(len(got), qid), got, scores))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*out)))))

    keys = ("leaf", "chunk", "grp")
    found = members.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    return best(found, k)


def best_with_leaf(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, with the leaf of the row found."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).select("query_id", "leaf")


def op7_ann_tree(spark, sf_dir) -> DataFrame:
    """The twenty nearest found of every twentieth embedding."""
    return ann_topk(table(spark, sf_dir, "embeddings"))

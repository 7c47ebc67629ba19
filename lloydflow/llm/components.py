"""Connected components of an edge table, by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of the component of every vertex of ``edges`` (a, b).

    Edges run parallel in a large group (its members meet more than once), so first every
    vertex keeps the edge to its least neighbour below it, and hands its other ones to that
    neighbour: the components stay the same, and about an edge a vertex is left.  Every round
    takes the least label among the neighbours and then the label's own
    label, so labels travel in doubling steps.  Each round's labels are
    written, so a lost executor costs that round at most.
    """
    down = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
                  "edges", light=True)
    least = down.groupBy("high").agg(F.min("low").alias("least"))
    handed = down.join(least.withColumnRenamed("high", "from"), F.col("high") == F.col("from")).filter("low <> least").select("low", "least")
    few = least.union(handed).toDF("a", "b").distinct()
    both = stored(few.union(few.select("b", "a")).distinct(), "edges", light=True)
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("root"))
                    .select("v", F.least("v", "root").alias("root")), "labels", light=True)
    while True:
        near = (both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v"))
                .agg(F.min("root").alias("near")))
        lower = stored(labels.join(near, "v", "left").select(
            "v", F.col("root").alias("was"), F.least("root", "near").alias("root")), "labels", light=True)
        jump = lower.select(F.col("v").alias("root"), F.col("root").alias("far"))
        nxt = stored(lower.join(jump, "root", "left").select(
            "v", "was", F.least("root", F.coalesce("far", "root")).alias("root")), "labels", light=True)
        labels = nxt.drop("was")
        if nxt.filter("was <> root").isEmpty():
            return labels

"""Direct checks of the smaller operators and column functions."""

from pyspark.sql import functions as F

from lloydflow import step
from lloydflow.functions import is_stable, movement, partials_equal
from lloydflow.operators import (
    apply_stats,
    assign_rank,
    cluster_stats,
    finalize_partials,
    order_by_center_text,
    partials,
    rank_by_center_text,
    seeds,
    status_message,
)
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.sources.centers import centers_frame, collapse_centers, next_centers

PTS = [(0, 0), (10, 0), (5, 0), (-1, 50), (-3, 50), (-4, 51), (0, 200), (0, 210), (300, 300), (301, 304)]
CTR = [(10, 0), (0, 0), (-2, 50), (5, 205), (300, 300), (9999, 9999)]


def test_join_form_equals_seed_union_form(spark):
    df = spark.createDataFrame(PTS, "x INT, y INT")
    ranked = prepare_centers(CTR)
    for mode in ("plain", "combined"):
        via_join = apply_stats(cluster_stats(assign_rank(df, ranked), mode), centers_frame(spark, ranked), mode)
        a = sorted(tuple(r) for r in via_join.select("rank", "new_x", "new_y", "old_x", "old_y", "n_points").collect())
        b = sorted(tuple(r) for r in step(df, CTR, mode).select("rank", "new_x", "new_y", "old_x", "old_y",
                                                                 "n_points").collect())
        assert a == b


def test_partials_struct_equality_and_finalize(spark):
    df = spark.createDataFrame([(i % 2, x, y) for i, (x, y) in enumerate(PTS)], "split INT, x INT, y INT")
    ranked = prepare_centers(CTR)
    parts = partials(assign_rank(df, ranked), ["split"])
    fin = {(r.split, r.center_rank): (r.avg_x, r.avg_y, r.n) for r in finalize_partials(parts).collect()}
    # split 1 holds (10,0) alone in cluster 0 → average (10, 0)
    assert fin[(1, 0)] == (10, 0, 1)
    pair = parts.select(F.struct("sum_x", "sum_y", "n").alias("a"), F.struct("sum_x", "sum_y", "n").alias("b"))
    assert all(r[0] for r in pair.select(partials_equal("a", "b")).collect())
    zero = seeds(centers_frame(spark, ranked)).collect()
    assert {(r.sum_x, r.sum_y, r.n, r.only_seed) for r in zero} == {(0, 0, 0, True)}


def test_ordering_and_next_centres(spark):
    res = spark.createDataFrame([(7, 0, 10, 0), (5, 5, 1, 5), (0, 0, -5, 1), (3, 3, 20, 3)],
                                "new_x INT, new_y INT, old_x INT, old_y INT")
    assert [(r.old_x, r.old_y) for r in order_by_center_text(res).collect()] == [(-5, 1), (1, 5), (10, 0), (20, 3)]
    ranked = rank_by_center_text(res, name="rank")
    assert sorted((r.rank, r.x, r.y) for r in next_centers(ranked).collect()) == [(0, 0, 0), (1, 5, 5), (2, 7, 0),
                                                                                 (3, 3, 3)]


def test_collapse_centres_frame(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 1, 1), (2, 8, 8), (3, 1, 1)], "rank INT, x INT, y INT")
    assert sorted(tuple(r) for r in collapse_centers(df).collect()) == [(0, 1, 1), (2, 8, 8)]


def test_movement_functions(spark):
    df = spark.createDataFrame([(100, 0, 0, 0), (0, 99, 0, 0), (-2147483648, 0, 2147483647, 0)],
                               "new_x INT, new_y INT, old_x INT, old_y INT")
    rows = df.select(movement("new_x", "new_y", "old_x", "old_y").alias("m"),
                     is_stable("new_x", "new_y", "old_x", "old_y").alias("s")).collect()
    assert [(r.m, r.s) for r in rows] == [(100, False), (99, True), (4294967295, False)]  # no 32-bit wrap
    assert status_message(df).collect()[0].status == "Has not converged"

"""Nearest-centre assignment: both physical forms against a brute-force scan."""

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from lloydflow.operators.assign import assign, assign_rank
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.plans.workload import lattice
from tests import brute


def _data(seed, n, k, span):
    rng = np.random.default_rng(seed)
    pts = [tuple(int(v) for v in p) for p in rng.integers(-span, span, size=(n, 2))]
    ctr = [tuple(int(v) for v in p) for p in rng.integers(-span, span, size=(k, 2))]
    return pts, ctr


@pytest.mark.parametrize("k", [1, 2, 7, 40])
@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
def test_matches_brute_force(spark, k, strategy):
    # a small coordinate span makes equal distances (ties) common
    pts, ctr = _data(k, 400, k, 12)
    df = spark.createDataFrame(pts, "x INT, y INT")
    got = sorted((r.center_x, r.center_y, r.x, r.y) for r in assign(df, prepare_centers(ctr), strategy=strategy)
                 .collect())
    assert got == brute.assignment(pts, ctr)


def test_tie_goes_to_first_centre(spark):
    df = spark.createDataFrame([(0, 0), (0, 7)], "x INT, y INT")
    for strategy in ("unrolled", "vectorized"):
        rows = assign(df, prepare_centers([(2, 0), (-2, 0)]), strategy=strategy).collect()
        assert {r.center_rank for r in rows} == {0}


def test_duplicate_centre_never_wins(spark):
    df = spark.createDataFrame([(1, 1)], "x INT, y INT")
    rows = assign_rank(df, prepare_centers([(5, 5), (1, 1), (1, 1)])).collect()
    assert rows[0].center_rank == 1


@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
def test_far_point_fails(spark, strategy):
    df = spark.createDataFrame([(0, 0), (2147483647, 2147483647)], "x INT, y INT")
    with pytest.raises((PySparkException, Py4JJavaError)):
        assign_rank(df, prepare_centers([(-2147483647, -2147483647)]), strategy=strategy).collect()


def test_large_lattice_both_forms_agree(spark):
    pts, _ = _data(3, 2000, 1, 12000)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ranked = prepare_centers(lattice(60))
    a = sorted(tuple(r) for r in assign(df, ranked, strategy="unrolled").collect())
    b = sorted(tuple(r) for r in assign(df, ranked, strategy="vectorized").collect())
    assert a == b


def test_extra_columns_kept(spark):
    df = spark.createDataFrame([(7, 1, 2, "a")], "id BIGINT, x INT, y INT, tag STRING")
    r = assign(df, prepare_centers([(0, 0)])).collect()[0]
    assert (r.id, r.tag, r.center_x, r.center_y) == (7, "a", 0, 0)


def test_candidate_cells_are_exact():
    from lloydflow.operators.nearest_kernel import _nearest, candidate_cells, nearest_indices

    rng = np.random.default_rng(7)
    for k, span, pspan in [(9, 50, 90), (130, 20, 40), (500, 3000, 9000), (300, 100000, 50), (2000, 4000, 5000)]:
        cx = rng.integers(-span, span, k).astype(float)
        cy = rng.integers(-span, span, k).astype(float)
        cx[:4], cy[:4] = cx[4:8], cy[4:8]  # duplicate centres
        cx[8], cy[8] = -9_000_000, -9_000_000  # a far one
        px = rng.integers(-pspan, pspan, 20000).astype(float)
        py = rng.integers(-pspan, pspan, 20000).astype(float)
        px[:5], py[:5] = 2e9, -2e9
        cells = candidate_cells(cx, cy)
        got = nearest_indices(px, py, cx, cy, cells)
        want = _nearest(px, py, cx, cy)
        assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])
        if k >= 500 and pspan > 50:
            assert cells["table"].shape[1] <= 32  # a far centre does not widen the lists of the others


@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
@pytest.mark.parametrize("point", [(None, 1), (1, None), (None, None)])
def test_null_coordinate_fails_with_the_same_message(spark, strategy, point):
    df = spark.createDataFrame([(1, 1), point], "x INT, y INT")
    with pytest.raises(Exception, match="point coordinate is NULL"):
        assign(df, prepare_centers([(0, 0), (5, 5)]), strategy=strategy).collect()


@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
def test_roots_that_tie_go_to_the_first_centre(spark, strategy):
    df = spark.createDataFrame([(0, 0), (1, 3)], "x INT, y INT")
    ctr = [(134217728, 2), (134217728, 0), *[(2**30 + i, -(2**30)) for i in range(12)]]
    got = assign(df, prepare_centers(ctr), strategy=strategy, prefix="rank_").collect()
    assert [(r.rank_rank, r.rank_x, r.rank_y) for r in got] == [(0, 134217728, 2)] * 2


def test_grid_path_in_spark_matches_brute_force(spark):
    pts, _ = _data(11, 3000, 1, 3000)
    ctr = lattice(200, cols=20, x0=-2500, dx=250, y0=-2500, dy=500)
    df = spark.createDataFrame(pts, "x INT, y INT")
    got = sorted((r.center_x, r.center_y, r.x, r.y) for r in assign(df, prepare_centers(ctr)).collect())
    assert got == brute.assignment(pts, ctr)


@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
def test_large_coordinates_agree_with_square_root_scan(spark, strategy):
    # |Δ| up to 4·10^7: squares stay exact in DOUBLE, so comparing d² picks the same
    # centre as the reference's comparison of square roots, ties included.
    rng = np.random.default_rng(21)
    span = 20_000_000
    pts = [tuple(int(v) for v in p) for p in rng.integers(-span, span, size=(1500, 2))]
    ctr = [tuple(int(v) for v in p) for p in rng.integers(-span // 2, span // 2, size=(12, 2)) * 2]
    pts.append(((ctr[0][0] + ctr[1][0]) // 2, (ctr[0][1] + ctr[1][1]) // 2))  # an exact tie
    df = spark.createDataFrame(pts, "x INT, y INT")
    got = sorted((r.center_x, r.center_y, r.x, r.y) for r in assign(df, prepare_centers(ctr), strategy=strategy)
                 .collect())
    assert got == brute.assignment(pts, ctr)

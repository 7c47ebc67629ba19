"""Edge cases of the iteration loop and its inputs."""

import pytest

from lloydflow import fit, read_points, step
from lloydflow.operators import assign_rank, merge_partials, partials
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.sources.centers import centers_frame
from tests import brute
from tests.conftest import write_text

PTS = [(0, 0), (10, 0), (5, 0), (-1, 50), (-3, 50), (-4, 51), (0, 200), (0, 210), (300, 300), (301, 304)]
CTR = [(10, 0), (0, 0), (-2, 50), (5, 205), (300, 300), (9999, 9999)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(PTS, "x INT, y INT")


def test_stop_any_never_tests_round_one(df):
    assert fit(df, CTR, iterations=1, mode="plain", stop="any").iterations_run == 1
    # round 1 already has stable centres, yet the test only starts at round 2
    assert fit(df, CTR, iterations=5, mode="plain", stop="any").iterations_run == 2


def test_stop_all_tests_round_one(df):
    assert fit(df, CTR, iterations=5, mode="plain", stop="all").iterations_run == 1


@pytest.mark.parametrize("kwargs", [{"mode": "other"}, {"stop": "never"}, {"persist": "disk"},
                                    {"strategy": "magic"}, {"resume": True}])
def test_bad_arguments(df, kwargs):
    with pytest.raises(ValueError):
        fit(df, CTR, iterations=1, **kwargs)


def test_step_rejects_bad_mode(df):
    with pytest.raises(ValueError):
        step(df, CTR, mode="other")


def test_points_from_several_paths(spark, scratch):
    d = scratch("paths")
    a = write_text(f"{d}/a.txt", "1,1\n2,2\n")
    b = write_text(f"{d}/b.txt", "3,3\n")
    assert sorted(tuple(r) for r in read_points(spark, [a, b]).collect()) == [(1, 1), (2, 2), (3, 3)]


def test_plain_partials_merge_equal_plain_step(spark):
    rows = [(i % 3, x, y) for i, (x, y) in enumerate(PTS * 3)]
    split_df = spark.createDataFrame(rows, "split INT, x INT, y INT")
    ranked = prepare_centers(CTR)
    merged = merge_partials(partials(assign_rank(split_df, ranked), ["split"], mode="plain"),
                            centers_frame(spark, ranked), mode="plain")
    got = sorted((r.new_x, r.new_y, r.old_x, r.old_y) for r in merged.collect())
    want = sorted(r[:4] for r in brute.step(PTS * 3, CTR, "plain"))
    assert got == want


@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
@pytest.mark.parametrize("persist", [True, "table"])
def test_collapse_with_each_strategy_and_persistence(spark, strategy, persist):
    import random

    rng = random.Random(9)
    pts = [(rng.choice([-1, rng.randint(-6, 6)]), rng.randint(-6, 6)) for _ in range(400)]
    ctr = [(rng.randint(-6, 6), rng.randint(-6, 6)) for _ in range(40)]
    df = spark.createDataFrame(pts, "x INT, y INT")
    for mode in ("plain", "combined"):
        got = fit(df, ctr, iterations=3, mode=mode, collapse=True, strategy=strategy, persist=persist)
        assert [it.rows for it in got.iterations] == brute.fit(pts, ctr, 3, mode)

"""Whole runs against the brute-force model, plus algebraic properties."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lloydflow import fit, step
from lloydflow.operators.aggregate import members, merge_partials, partials
from lloydflow.operators.assign import assign, assign_rank
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.sources.centers import centers_frame
from lloydflow.sources.points import collapse_points
from tests import brute

coord = st.integers(min_value=-30, max_value=30)
point = st.tuples(coord, coord)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(pts=st.lists(point, min_size=1, max_size=60), ctr=st.lists(point, min_size=1, max_size=6),
       mode=st.sampled_from(["plain", "combined"]), stop=st.sampled_from(["none", "any", "all"]))
def test_fit_matches_model(spark, pts, ctr, mode, stop):
    # x = -1 is common in this range, so the plain-mode rules are exercised
    df = spark.createDataFrame(pts, "x INT, y INT")
    got = fit(df, ctr, iterations=4, mode=mode, stop=stop, persist=False)
    want = brute.fit(pts, ctr, 4, mode, stop)
    assert [it.rows for it in got.iterations] == want


def _random(seed, n=3000, span=500):
    rng = np.random.default_rng(seed)
    return [tuple(int(v) for v in p) for p in rng.integers(-span, span, size=(n, 2))]


@pytest.mark.parametrize("mode", ["plain", "combined"])
def test_weighted_equals_unweighted(spark, mode):
    pts = _random(1, span=8)  # many repeated points
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(-3, -3), (0, 4), (5, 1)]
    a = sorted(tuple(r) for r in step(df, ctr, mode).collect())
    b = sorted(tuple(r) for r in step(collapse_points(df), ctr, mode, weight="weight").collect())
    assert a == b


def test_partials_merge_equals_direct(spark):
    pts = _random(2)
    df = spark.createDataFrame([(i % 5, x, y) for i, (x, y) in enumerate(pts)], "split INT, x INT, y INT")
    ranked = prepare_centers([(0, 0), (300, 300), (-300, 200), (9999, 9999)])
    parts = partials(assign_rank(df, ranked), ["split"])
    assert parts.groupBy().sum("n").collect()[0][0] == len(pts)
    merged = sorted((r.rank, r.new_x, r.new_y, r.old_x, r.old_y, r.n_points)
                    for r in merge_partials(parts, centers_frame(spark, ranked)).collect())
    direct = sorted((r.rank, r.new_x, r.new_y, r.old_x, r.old_y, r.n_points)
                    for r in step(df.select("x", "y"), [(0, 0), (300, 300), (-300, 200), (9999, 9999)]).collect())
    assert merged == direct


def test_repartition_invariance(spark):
    df = spark.createDataFrame(_random(3), "x INT, y INT")
    ctr = [(0, 0), (250, -250), (-250, 250)]
    a = fit(df.repartition(1), ctr, iterations=3).iterations[-1].rows
    b = fit(df.repartition(13), ctr, iterations=3).iterations[-1].rows
    assert a == b


def test_members_rows_and_average(spark):
    pts = [(0, 0), (1, 0), (-7, 0), (100, 100)]
    df = spark.createDataFrame(pts, "x INT, y INT")
    m = members(assign(df, prepare_centers([(0, 0), (100, 100)]))).collect()
    assert len(m) == len(pts)
    first = {(r.x, r.y): r for r in m}
    assert first[(-7, 0)].avg_x == -2 and first[(-7, 0)].n_members == 3  # (0+1-7)/3 truncates toward zero
    assert first[(1, 0)].member == "(1,0)"


@pytest.mark.parametrize("persist", [True, "table", False])
def test_persist_modes_agree(spark, persist):
    pts = _random(4, n=2000)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(0, 0), (250, -250), (-250, 250)]
    got = fit(df, ctr, iterations=3, mode="plain", persist=persist)
    assert [it.rows for it in got.iterations] == brute.fit(pts, ctr, 3, "plain")


@pytest.mark.parametrize("mode", ["plain", "combined"])
def test_fit_collapse_is_exact(spark, mode):
    pts = _random(5, span=6)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(-3, -3), (0, 4), (5, 1), (0, 4)]
    got = fit(df, ctr, iterations=3, mode=mode, collapse=True, persist=False)
    assert [it.rows for it in got.iterations] == brute.fit(pts, ctr, 3, mode)
    assert got.points_read.count() == len(set(pts)) < len(pts)  # rounds read distinct points only
    assert got.assignment(df).count() == len(pts)


@pytest.mark.parametrize("status_files", [False, True])
def test_resume_continues_like_an_uninterrupted_run(spark, scratch, status_files):
    import os

    pts = _random(6, n=1500)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(0, 0), (250, -250), (-250, 250), (400, 400)]
    prefix = scratch("resume") + "/run"
    fit(df, ctr, iterations=2, mode="combined", output_prefix=prefix, status_files=status_files)
    for r in (1, 2):
        os.remove(f"{prefix}{r}/_SUCCESS")  # some committers leave no marker
    os.makedirs(prefix + "3")  # a round folder the lost driver never committed
    open(prefix + "3/part-00000", "w").write("garbage\n")
    res = fit(df, ctr, iterations=4, mode="combined", output_prefix=prefix, status_files=status_files, resume=True)
    assert res.resumed_from == 2 and [it.iteration for it in res.iterations] == [1, 2, 3, 4]
    whole = fit(df, ctr, iterations=4, mode="combined")
    assert [it.rows for it in res.iterations] == brute.fit(pts, ctr, 4, "combined")
    assert res.history().drop("seconds").collect() == whole.history().drop("seconds").collect()
    assert os.path.exists(prefix + "3/_SUCCESS")
    for other in ({"mode": "plain"}, {"stop": "all"}, {"threshold": 7}):
        with pytest.raises(ValueError):
            fit(df, ctr, **({"iterations": 4, "mode": "combined", "output_prefix": prefix, "status_files": status_files, "resume": True} | other))
    with pytest.raises(ValueError):
        fit(df, ctr[:2], iterations=4, mode="combined", output_prefix=prefix, status_files=status_files, resume=True)


def test_resume_after_a_finished_stop(spark, scratch):
    pts = _random(7, n=800)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(0, 0), (250, -250), (-250, 250)]
    prefix = scratch("resume-stop") + "/run"
    first = fit(df, ctr, iterations=20, mode="plain", stop="all", output_prefix=prefix)
    again = fit(df, ctr, iterations=20, mode="plain", stop="all", output_prefix=prefix, resume=True)
    assert again.resumed_from == first.iterations_run == len(again.iterations) and again.converged
    assert again.result().collect() == first.result().collect()
    assert again.final_centers == first.final_centers


def test_rounds_without_a_record_are_not_resumed(spark, scratch):
    import shutil

    df = spark.createDataFrame(_random(9, n=100), "x INT, y INT")
    prefix = scratch("resume-bare") + "/run"
    fit(df, [(0, 0), (50, 50)], iterations=1, output_prefix=prefix)
    shutil.move(prefix + "Run", prefix + "Elsewhere")
    with pytest.raises(ValueError):
        fit(df, [(0, 0), (50, 50)], iterations=2, output_prefix=prefix, resume=True)


def test_table_persistence_leaves_no_copy(spark, scratch):
    import os

    from lloydflow.session import shared_dir

    df = spark.createDataFrame(_random(10, n=100), "x INT, y INT")
    folder = shared_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(folder) if f.startswith("points-")}
    fit(df, [(0, 0), (50, 50)], iterations=2, persist="table")
    assert {f for f in os.listdir(folder) if f.startswith("points-")} == before


def test_rounds_at_a_fixed_point_are_run_and_timed(spark):
    pts = _random(8, n=600, span=50)
    df = spark.createDataFrame(pts, "x INT, y INT")
    ctr = [(-20, -20), (20, 20), (0, 30)]
    got = fit(df, ctr, iterations=12, mode="combined")
    assert [it.rows for it in got.iterations] == brute.fit(pts, ctr, 12, "combined")
    assert len(got.iterations) == 12 and all(it.seconds > 0 for it in got.iterations)

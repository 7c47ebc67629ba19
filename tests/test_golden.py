"""The hand-checked fixture: tie, empty cluster, x = -1, zero x-sum, negative truncation."""

import pytest

from lloydflow import fit, step
from lloydflow.functions.constants import STATUS_CONVERGED

POINTS = [(0, 0), (10, 0), (5, 0), (-1, 50), (-3, 50), (-4, 51), (0, 200), (0, 210), (300, 300), (301, 304)]
CENTERS = [(10, 0), (0, 0), (-2, 50), (5, 205), (300, 300), (9999, 9999)]

# (new_x, new_y, old_x, old_y) in output order, per iteration.
EXPECTED = {
    "plain": [
        [(-3, 50, -2, 50), (0, 0, 0, 0), (7, 0, 10, 0), (300, 302, 300, 300), (5, 205, 5, 205),
         (9999, 9999, 9999, 9999)],
        [(-3, 50, -3, 50), (0, 0, 0, 0), (300, 302, 300, 302), (5, 205, 5, 205), (7, 0, 7, 0),
         (9999, 9999, 9999, 9999)],
    ],
    "combined": [
        [(-2, 50, -2, 50), (0, 0, 0, 0), (7, 0, 10, 0), (300, 302, 300, 300), (0, 205, 5, 205),
         (9999, 9999, 9999, 9999)],
        [(-2, 50, -2, 50), (0, 0, 0, 0), (0, 205, 0, 205), (300, 302, 300, 302), (7, 0, 7, 0),
         (9999, 9999, 9999, 9999)],
    ],
}


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "x INT, y INT")


@pytest.mark.parametrize("mode", ["plain", "combined"])
@pytest.mark.parametrize("strategy", ["unrolled", "vectorized"])
def test_two_iterations(points, mode, strategy):
    res = fit(points, CENTERS, iterations=2, mode=mode, strategy=strategy)
    got = [[r[:4] for r in it.rows] for it in res.iterations]
    assert got == EXPECTED[mode]
    assert res.iterations[0].status == STATUS_CONVERGED


def test_step_dataframe_matches(points):
    rows = step(points, CENTERS, "plain").collect()
    assert sorted((r.new_x, r.new_y, r.old_x, r.old_y) for r in rows) == sorted(EXPECTED["plain"][0])
    assert sum(r.n_points for r in rows) == len(POINTS)


def test_final_listing_has_no_empty_centre(points):
    res = fit(points, CENTERS, iterations=1, mode="combined")
    listing = res.assignment(points).collect()
    assert len(listing) == len(POINTS)
    assert (9999, 9999) not in {(r.center_x, r.center_y) for r in listing}
    # the tie of (5,0) between (10,0) and (0,0) went to the first centre, (10,0) → now (7,0)
    assert {(r.x, r.y): (r.center_x, r.center_y) for r in listing}[(5, 0)] == (7, 0)


def test_status_rows_and_history(points):
    res = fit(points, CENTERS, iterations=2, mode="plain")
    st = res.status_rows().collect()
    assert {r.status for r in st} == {STATUS_CONVERGED}
    assert [(r.x, r.y) for r in st if r.iteration == 1] == [row[:2] for row in EXPECTED["plain"][0]]
    hist = res.history().collect()
    assert [h.iteration for h in hist] == [1, 2]
    assert hist[0].k == 6 and hist[0].n_points == 10 and hist[1].max_move == 0

"""The command line runs the six program variants with the reference's output layout."""

import os

import pytest

from lloydflow.cli import main
from lloydflow.sources import read_assignments, read_result, read_status_centers
from tests.conftest import write_text

POINTS = "0,0\n10,0\n5,0\n-1,50\n-3,50\n-4,51\n0,200\n0,210\n300,300\n301,304\n"
CENTERS = "10,0\n0,0\n-2,50\n5,205\n300,300\n9999,9999\n"


@pytest.fixture()
def inputs(scratch):
    d = scratch("cli")
    return write_text(f"{d}/points.txt", POINTS), write_text(f"{d}/centers.txt", CENTERS), d


def test_plain_two_rounds(spark, inputs):
    pts, ctr, d = inputs
    main(["plain", pts, ctr, f"{d}/out", "2"], spark=spark)
    rows = [tuple(r)[1:] for r in read_result(spark, f"{d}/out2").orderBy("rank").collect()]
    assert rows[0] == (-3, 50, -3, 50) and rows[2] == (300, 302, 300, 302)
    assert os.path.isdir(f"{d}/out1") and not os.path.exists(f"{d}/out3")


def test_stop_all_stops_at_round_one(spark, inputs):
    pts, ctr, d = inputs
    main(["stop-all", pts, ctr, f"{d}/out", "4"], spark=spark)
    assert os.path.isdir(f"{d}/out1") and not os.path.exists(f"{d}/out2")


def test_status_and_listing(spark, inputs):
    pts, ctr, d = inputs
    main(["status", pts, ctr, f"{d}/st", "1"], spark=spark)
    st = read_status_centers(spark, f"{d}/st1").orderBy("rank").collect()
    assert st[0].status == "Has converged" and (st[4].x, st[4].y) == (0, 205)
    main(["listing", pts, ctr, f"{d}/ls", "1"], spark=spark)
    listing = read_assignments(spark, f"{d}/lsFinal").collect()
    assert len(listing) == 10 and (9999, 9999) not in {(r.center_x, r.center_y) for r in listing}


def test_stop_any_combined_collapse_and_table(spark, inputs):
    pts, ctr, d = inputs
    main(["stop-any", pts, ctr, f"{d}/sa", "5"], spark=spark)
    assert os.path.isdir(f"{d}/sa2") and not os.path.exists(f"{d}/sa3")  # never tested before round 2
    main(["combined", pts, ctr, f"{d}/cb", "2", "--collapse", "--persist", "table"], spark=spark)
    rows = [tuple(r)[1:] for r in read_result(spark, f"{d}/cb2").orderBy("rank").collect()]
    assert (0, 205, 0, 205) in rows and (-2, 50, -2, 50) in rows


def test_resume_flag(spark, inputs):
    pts, ctr, d = inputs
    main(["plain", pts, ctr, f"{d}/rs", "1"], spark=spark)
    main(["plain", pts, ctr, f"{d}/rs", "2", "--resume"], spark=spark)
    rows = [tuple(r)[1:] for r in read_result(spark, f"{d}/rs2").orderBy("rank").collect()]
    assert rows[0] == (-3, 50, -3, 50)

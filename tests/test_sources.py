"""Sources, sinks and exchange formats: accepted / rejected inputs and round trips."""

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from lloydflow import fit
from lloydflow.sources import (
    centers_from_json,
    centers_to_json,
    read_assignments,
    read_centers,
    read_points,
    read_result,
    read_status_centers,
    to_json_text,
    write_assignments,
    write_result,
)
from lloydflow.sources.centers import as_center_list, centers_frame, ranked_distinct
from lloydflow.sources.points import parse_point_lines
from tests.conftest import write_text

FAILS = (PySparkException, Py4JJavaError)


def _parse(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    return [tuple(r) for r in parse_point_lines(df).collect()]


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_point_lines_accepted(spark, ansi):
    lines = ["+5,-6", "5,6,7,abc", "007,-0", "2147483647,-2147483648", "000000000000012,-0000000000003"]
    assert _parse(spark, lines) == [(5, -6), (5, 6), (7, 0), (2147483647, -2147483648), (12, -3)]


@pytest.mark.parametrize("bad", ["x,y", "", "1.5,2", " 5,6", "5", "5,", "2147483648,0", "0,-2147483649",
                                 "99999999999999999999999,1", "5\t6", "1,2 ", "+,1", "1,--2"])
def test_point_lines_rejected(spark, ansi, bad):
    with pytest.raises(FAILS):
        _parse(spark, ["1,2", bad])


def test_read_points_file(spark, scratch):
    d = scratch("pts")
    write_text(f"{d}/part-a.txt", "1,2\n3,4,extra\r\n-5,6\n")
    write_text(f"{d}/part-b.txt", "7,8")
    assert sorted(tuple(r) for r in read_points(spark, d).collect()) == [(-5, 6), (1, 2), (3, 4), (7, 8)]


def test_read_centers_order_and_separators(spark, scratch):
    p = write_text(f"{scratch('c')}/centers.txt", "10,0\n0\t0\n-2,50,ignored\n5,205\n\n\n")
    rows = [tuple(r) for r in read_centers(spark, p).orderBy("rank").collect()]
    assert rows == [(0, 10, 0), (1, 0, 0), (2, -2, 50), (3, 5, 205)]


@pytest.mark.parametrize("text", ["1,2\n\n3,4\n", "1,2\nabc\n", "1.0,2\n"])
def test_read_centers_rejects(spark, scratch, text):
    p = write_text(f"{scratch('c')}/centers.txt", text)
    with pytest.raises(FAILS):
        read_centers(spark, p).collect()


def test_empty_centre_file_fails(spark, scratch):
    p = write_text(f"{scratch('c')}/centers.txt", "")
    with pytest.raises((ValueError, *FAILS)):
        as_center_list(read_centers(spark, p))


def test_status_file(spark, scratch):
    p = write_text(f"{scratch('s')}/part-r-00000", "Has not converged\n1,2\n3,4\n")
    rows = [tuple(r) for r in read_status_centers(spark, p).orderBy("rank").collect()]
    assert rows == [("Has not converged", 0, 1, 2), ("Has not converged", 1, 3, 4)]


def test_result_file(spark, scratch):
    p = write_text(f"{scratch('r')}/part-r-00000", "7,0\t10,0\n-3,50\t-2,50\n")
    rows = [tuple(r) for r in read_result(spark, p).orderBy("rank").collect()]
    assert rows == [(0, 7, 0, 10, 0), (1, -3, 50, -2, 50)]


def test_result_sink_roundtrip_and_order(spark, scratch):
    df = spark.createDataFrame([(1, 0, 20, 3, 20, 3, 1), (1, 1, 1, 5, 1, 5, 1), (1, 2, -5, 1, -5, 1, 1),
                                (1, 3, 100, 5, 10, 2, 1)],
                               "iteration INT, pos INT, new_x INT, new_y INT, old_x INT, old_y INT, n_points BIGINT")
    path = scratch("out")
    write_result(df, path)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    # byte order of the old-centre text: "-5,1" < "1,5" < "10,2" < "20,3"
    assert text.splitlines() == ["-5,1\t-5,1", "1,5\t1,5", "100,5\t10,2", "20,3\t20,3"]
    with pytest.raises(FAILS):
        write_result(df, path)  # existing output path fails, as in the reference


def test_fit_output_family(spark, scratch):
    pts = spark.createDataFrame([(0, 0), (10, 0), (100, 100)], "x INT, y INT")
    prefix = scratch("fam") + "/run"
    fit(pts, [(0, 0), (100, 100)], iterations=2, output_prefix=prefix, status_files=True, final_listing=True)
    assert os.path.isdir(prefix + "1") and os.path.isdir(prefix + "2") and os.path.isdir(prefix + "Final")
    st = read_status_centers(spark, prefix + "2").orderBy("rank").collect()
    # output order is the byte order of the old-centre text: "100,100" < "5,0"
    assert [(r.status, r.x, r.y) for r in st] == [("Has converged", 100, 100), ("Has converged", 5, 0)]
    listing = sorted(tuple(r) for r in read_assignments(spark, prefix + "Final").collect())
    assert listing == [(5, 0, 0, 0), (5, 0, 10, 0), (100, 100, 100, 100)]
    text = open(next(os.path.join(prefix + "Final", f) for f in sorted(os.listdir(prefix + "Final"))
                     if f.startswith("part-") and os.path.getsize(os.path.join(prefix + "Final", f)))).read()
    assert text.splitlines()[0].endswith(" ")


def test_assignment_sink_sorted(spark, scratch):
    df = spark.createDataFrame([(10, 2, 9, 9), (1, 5, 3, 3), (1, 5, 0, 1), (-5, 1, 4, 4)],
                               "center_x INT, center_y INT, x INT, y INT")
    path = scratch("listing")
    write_assignments(df, path)
    lines = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            lines += open(os.path.join(path, f)).read().splitlines()
    assert lines == ["-5,1\t4,4 ", "1,5\t0,1 ", "1,5\t3,3 ", "10,2\t9,9 "]


def test_json_roundtrip(spark):
    ranked = ranked_distinct([(1000, 1000), (-2, 8000), (5, 5)])
    js = centers_to_json(centers_frame(spark, ranked)).collect()[0][0]
    assert js == '[{"x":1000,"y":1000},{"x":-2,"y":8000},{"x":5,"y":5}]'
    assert js == to_json_text([(1000, 1000), (-2, 8000), (5, 5)])
    back = centers_from_json(spark.createDataFrame([(js,)], "centers_json STRING")).orderBy("rank").collect()
    assert [tuple(r) for r in back] == [(0, 1000, 1000), (1, -2, 8000), (2, 5, 5)]


def test_duplicate_centres_collapse():
    assert ranked_distinct([(1, 1), (1, 1), (8, 8), (1, 1)]) == [(0, 1, 1), (2, 8, 8)]


def test_iterations_must_be_positive(spark):
    pts = spark.createDataFrame([(0, 0)], "x INT, y INT")
    with pytest.raises(ValueError):
        fit(pts, [(0, 0)], iterations=0)
    with pytest.raises(ValueError):
        fit(pts, [], iterations=1)


def test_centres_across_files_rank_by_file_then_line(spark, scratch):
    d = scratch("multi")
    write_text(f"{d}/part-00001", "5,5\n6,6\n")
    write_text(f"{d}/part-00000", "1,1\n2,2\n")
    rows = [tuple(r) for r in read_centers(spark, d).orderBy("rank").collect()]
    assert rows == [(0, 1, 1), (1, 2, 2), (2, 5, 5), (3, 6, 6)]


def test_points_from_rejects_null_and_overflow(spark, ansi):
    from lloydflow.sources.points import points_from

    ok = spark.createDataFrame([(1, 2)], "a BIGINT, b BIGINT")
    assert [tuple(r) for r in points_from(ok, "a", "b").collect()] == [(1, 2)]
    for row in [(None, 2), (2147483648, 0), (0, -2147483649)]:
        df = spark.createDataFrame([row], "a BIGINT, b BIGINT")
        with pytest.raises(FAILS):
            points_from(df, "a", "b").collect()


def test_local_frame_small_and_large(spark):
    from lloydflow.session import VALUES_MAX_ROWS, local_frame

    for n in (3, VALUES_MAX_ROWS + 50):
        rows = [(i, -i, f"s'{i}", i * 0.5) for i in range(n)]
        df = local_frame(spark, rows, "a INT, b BIGINT, c STRING, d DOUBLE")
        assert [tuple(r) for r in df.orderBy("a").collect()] == rows
        assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "bigint", "string", "double"]


def test_centre_files_of_any_length_are_numbered_across_files(spark, scratch):
    d = scratch("big")
    write_text(f"{d}/a.txt", "\n".join(f"{i},{-i}" for i in range(12_000)) + "\n")
    write_text(f"{d}/b.txt", "7,7\n8,8\n")
    got = [tuple(r) for r in read_centers(spark, f"{d}/*.txt").orderBy("rank").collect()]
    assert got == [(i, i, -i) for i in range(12_000)] + [(12_000, 7, 7), (12_001, 8, 8)]


def test_centres_without_a_rank_are_refused(spark):
    from lloydflow.sources.centers import as_center_list

    with pytest.raises(ValueError):
        as_center_list(spark.createDataFrame([(1, 1)], "x INT, y INT"))


def test_json_export_per_group_in_rank_order(spark):
    df = spark.createDataFrame([("a", 1, 5, 5), ("a", 0, -1, 2), ("b", 0, 7, 7)], "g STRING, rank INT, x INT, y INT")
    got = {r.g: r.centers_json for r in centers_to_json(df, group_cols=["g"]).collect()}
    assert got == {"a": '[{"x":-1,"y":2},{"x":5,"y":5}]', "b": '[{"x":7,"y":7}]'}


def test_shared_dir_needs_a_cluster_folder_off_local(monkeypatch):
    from lloydflow.session import shared_dir

    class Ctx:
        master = "spark://cluster:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Ctx()

    with pytest.raises(RuntimeError):
        shared_dir(Session())

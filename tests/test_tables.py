"""Centres as a table: the tiled search, the loop over tables, files in splits, the run record."""

import os
import random
import re
import subprocess
import sys

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lloydflow import fit, step
from lloydflow.operators import tiles
from lloydflow.operators.ordering import number_rows, running_totals
from lloydflow.operators.tile_kernel import Tiles, merged
from lloydflow.operators.uneven import join_by_size
from lloydflow.plans.record import RunRecord
from lloydflow.session import clear_scratch
from lloydflow.sources import read_centers, read_centers_json, read_result, read_status_centers, sinks, write_centers_json
from lloydflow.sources.centers import as_center_list, ranked_table
from tests import brute
from tests.conftest import ROOT, write_text

FAILS = (PySparkException, Py4JJavaError)


def centers_df(spark, pairs):
    return spark.createDataFrame([(10 * i, *p) for i, p in enumerate(pairs)], "rank INT, x INT, y INT").repartition(3)


def points_df(spark, pts):
    return spark.createDataFrame(pts, "x INT, y INT").repartition(4)


def layouts():
    rng = random.Random(11)
    r = lambda n: rng.randint(-n, n)
    cloud = [(r(300), r(300)) for _ in range(400)]
    yield "spread", [(r(320), r(320)) for _ in range(700)], cloud
    yield "one column", [(r(50), r(500)) for _ in range(500)], [(7, i - 200) for i in range(400)]
    yield "one row, far points", [(r(9), r(9) * 10_000) for _ in range(300)], [(i, 3) for i in range(300)]
    yield "clusters and a far centre", [(rng.choice((0, 5000)) + r(40), r(40)) for _ in range(600)], \
        [(rng.choice((0, 5000)) + r(30), r(30)) for _ in range(300)] + [(-2_000_000, 9)]
    yield "ties on a lattice", [(r(30), r(30)) for _ in range(900)], [(2 * (i % 20) - 20, 2 * (i // 20) - 20) for i in range(400)]
    yield "one repeated point", [(3, 4)] * 3000 + [(r(100), r(100)) for _ in range(50)], cloud
    yield "equal centres", [(r(60), r(60)) for _ in range(300)], [(r(9), r(9)) for _ in range(300)]


@pytest.mark.parametrize("name,pts,ctr", list(layouts()), ids=[x[0] for x in layouts()])
def test_step_over_a_table_equals_the_reference(spark, monkeypatch, name, pts, ctr):
    monkeypatch.setattr(tiles.build_index, "__defaults__", (30,))
    monkeypatch.setattr(tiles, "GROUP_POINTS", 100)
    for mode in ("plain", "combined"):
        got = sorted(tuple(r)[2:] for r in step(points_df(spark, pts), centers_df(spark, ctr), mode=mode, in_plan=0).collect())
        assert got == sorted(brute.step(pts, list(dict.fromkeys(ctr)), mode))


def test_assignment_keeps_rows_and_columns(spark, scratch, monkeypatch):
    monkeypatch.setattr(tiles, "GROUP_POINTS", 50)
    rng = random.Random(4)
    pts = [(i % 40, rng.randint(-90, 90), rng.randint(-90, 90)) for i in range(500)] + [(7, 1, 1)] * 200
    ctr = [(rng.randint(-80, 80), rng.randint(-80, 80)) for _ in range(200)]
    df = spark.createDataFrame(pts, "center_id INT, px INT, py INT")
    index = tiles.build_index(ranked_table(centers_df(spark, ctr)), per_tile=20)
    path = scratch("index")
    index.save(path)
    for i in (index, tiles.TileIndex.load(spark, path)):
        got = sorted(tuple(r) for r in tiles.assign_table(df, i, "px", "py").select("center_id", "px", "py", "center_x", "center_y").collect())
        assert got == sorted((k, x, y, *brute.nearest(x, y, list(dict.fromkeys(ctr)))) for k, x, y in pts)


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_an_index_of_many_tiles_is_saved_and_loaded(spark, scratch, arrow):
    """More tiles than a VALUES list takes, the last of each strip without a cut."""
    side, spacing = 40, 10
    index = tiles.build_index(ranked_table(centers_df(spark, [(x * spacing, y * spacing) for x in range(side) for y in range(side)])), per_tile=4)
    assert index.tiles.n > 256
    path, kept = scratch("index"), spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    try:
        index.save(path)
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", kept)
    again = tiles.TileIndex.load(spark, path).tiles
    assert again.x_cuts.tolist() == index.tiles.x_cuts.tolist()
    assert [c.tolist() for c in again.y_cuts] == [c.tolist() for c in index.tiles.y_cuts]
    for name in ("x0", "x1", "y0", "y1"):
        assert getattr(again, name).tolist() == getattr(index.tiles, name).tolist()


def test_table_search_fails_like_the_list(spark):
    far = [(-2147483648, -2147483648)] + [(-2147483648 + i, -2147483648) for i in range(1, 50)]
    bad = spark.createDataFrame([(1, 1), (None, 3)], "x INT, y INT")
    with pytest.raises(FAILS, match="NULL"):
        step(bad, centers_df(spark, [(i, i) for i in range(50)]), in_plan=0).collect()
    with pytest.raises(FAILS, match="every centre"):
        step(points_df(spark, [(2147483647, 2147483647)]), centers_df(spark, far), in_plan=0).collect()
    with pytest.raises(ValueError):
        tiles.build_index(spark.createDataFrame([], "rank INT, x INT, y INT"))


def test_long_lists_are_not_collected(spark, monkeypatch):
    long = spark.range(5000).selectExpr("CAST(id AS INT) AS rank", "CAST(id AS INT) AS x", "CAST(0 AS INT) AS y")
    with pytest.raises(ValueError, match="table"):
        as_center_list(long)
    from lloydflow.plans import lloyd

    monkeypatch.setattr(lloyd, "prepare_centers", lambda *a: pytest.fail("centres came to the driver"))
    out = step(points_df(spark, [(i, 1) for i in range(100)]), long).collect()
    assert len(out) == 5000 and sum(r.n_points for r in out) == 100


def test_tiles_within_finds_every_box():
    rng = np.random.default_rng(3)
    x_cuts, y_cuts = [-50, 0, 40], [[0], [], [-30, 10, 30], [5]]
    t = Tiles(x_cuts, y_cuts)
    c = rng.integers(-100, 100, (400, 2)).astype(float)
    own = t.tile_of(c[:, 0], c[:, 1])
    boxes = [(c[own == i, 0].min(), c[own == i, 0].max(), c[own == i, 1].min(), c[own == i, 1].max()) for i in range(t.n)]
    t = Tiles(x_cuts, y_cuts, boxes)
    p = rng.integers(-150, 150, (300, 2)).astype(float)
    reach = rng.uniform(0, 120, 300)
    i, j = t.within(p[:, 0], p[:, 1], reach, own=2)
    got = set(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(300) for b, (x0, x1, y0, y1) in enumerate(boxes) if b != 2 and np.hypot(
        max(x0 - p[a, 0], p[a, 0] - x1, 0), max(y0 - p[a, 1], p[a, 1] - y1, 0)) <= reach[a]}
    assert got == want and len(got) == len(i)
    x, y, w = merged(np.array([3, 1, 3, 3]), np.array([1, 1, 1, 2]), np.array([1, 2, 3, 4]))
    assert list(zip(x, y, w)) == [(1, 1, 2), (3, 1, 4), (3, 2, 4)]


@pytest.mark.parametrize("mode,stop,collapse", [("plain", "all", False), ("combined", "any", True), ("combined", "none", False)])
def test_rounds_over_a_table_equal_the_list_form(spark, scratch, mode, stop, collapse):
    rng = random.Random(5)
    pts = [(rng.choice([-1, rng.randint(-900, 900)]), rng.randint(-900, 900)) for _ in range(800)]
    ctr = [(rng.randint(-900, 900), rng.randint(-900, 900)) for _ in range(60)]
    options = {"iterations": 4, "mode": mode, "stop": stop, "threshold": 60, "collapse": collapse, "final_listing": True}
    a, b = scratch("table") + "/it", scratch("list") + "/it"
    got = fit(points_df(spark, pts), centers_df(spark, ctr), in_plan=0, output_prefix=a, **options)
    want = fit(points_df(spark, pts), ctr, output_prefix=b, **options)
    assert got.iterations_run == want.iterations_run and got.converged == want.converged
    cols = ["iteration", "pos", "new_x", "new_y", "old_x", "old_y", "n_points"]
    assert got.results().select(*cols).orderBy(*cols).collect() == want.results().select(*cols).orderBy(*cols).collect()
    assert got.history().drop("seconds").collect() == want.history().drop("seconds").collect()
    assert sorted(got.status_rows().collect()) == sorted(want.status_rows().collect())
    assert [tuple(r) for r in got.final_centers.orderBy("rank").collect()] == want.final_centers
    last = got.last_iteration
    assert read_result(spark, f"{a}{last}").orderBy("rank").collect() == read_result(spark, f"{b}{last}").orderBy("rank").collect()
    assert text_of(f"{a}Final") == text_of(f"{b}Final")


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "far.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {ROOT!r})  # the driver's path alone
from lloydflow.session import local_session
from lloydflow import step, fit
spark = local_session(2)
pts = spark.range(300).selectExpr("CAST(id % 37 AS INT) AS x", "CAST(id % 23 AS INT) AS y")
ctr = spark.range(90).selectExpr("CAST(id AS INT) AS rank", "CAST(id * 7 % 41 AS INT) AS x", "CAST(id * 5 % 29 AS INT) AS y")
a = sorted(map(tuple, step(pts, ctr, in_plan=0).collect()))
assert a == sorted(map(tuple, step(pts, ctr).collect())) and len(a) == 90, a
assert fit(pts, ctr, in_plan=0).assignment(pts).count() == 300
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_points_of_one_split_are_dealt_on_request(spark):
    pts = spark.createDataFrame([(i % 50, i % 31) for i in range(500)], "x INT, y INT").coalesce(1)
    got = fit(pts, [(0, 0), (40, 20)], iterations=2, partitions=6)
    assert got.iterations[-1].rows == fit(pts, [(0, 0), (40, 20)], iterations=2).iterations[-1].rows
    assert got.points_read.rdd.getNumPartitions() == 6


def text_of(path):
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return "".join(open(os.path.join(path, f)).read() for f in files)


def test_table_run_resumes(spark, scratch):
    rng = random.Random(6)
    pts = [(rng.randint(-500, 500), rng.randint(-500, 500)) for _ in range(400)]
    ctr = [(rng.randint(-500, 500), rng.randint(-500, 500)) for _ in range(40)]
    prefix = scratch("table-resume") + "/it"
    fit(points_df(spark, pts), centers_df(spark, ctr), iterations=2, output_prefix=prefix, in_plan=0)
    clear_scratch(spark)  # a later driver finds nothing but the run's own folders
    res = fit(points_df(spark, pts), centers_df(spark, ctr), iterations=4, output_prefix=prefix, in_plan=0, resume=True)
    assert res.resumed_from == 2
    got = {}
    for r in res.results().orderBy("iteration", "pos").collect():
        got.setdefault(r.iteration, []).append((r.new_x, r.new_y, r.old_x, r.old_y, r.n_points))
    assert list(got.values()) == brute.fit(pts, ctr, 4, "combined")
    with pytest.raises(ValueError):
        fit(points_df(spark, pts), centers_df(spark, ctr[::-1]), iterations=4, output_prefix=prefix, in_plan=0, resume=True)


def test_a_refused_start_leaves_the_record_of_the_first_run(spark, scratch):
    pts = points_df(spark, [(i % 17, i % 23) for i in range(200)])
    ctr, other = [(0, 0), (9, 9), (3, 14), (16, 2), (8, 20)], [(1, 1), (12, 12)]
    prefix = scratch("claimed") + "/it"
    first = fit(pts, ctr, iterations=2, mode="plain", output_prefix=prefix)
    before = sorted(os.listdir(prefix + "Run"))
    with pytest.raises(FileExistsError):
        fit(pts, other, iterations=2, mode="combined", output_prefix=prefix)
    assert sorted(os.listdir(prefix + "Run")) == before
    with pytest.raises(ValueError):  # the refused run's settings are not those on record
        fit(pts, other, iterations=3, mode="combined", output_prefix=prefix, resume=True)
    again = fit(pts, ctr, iterations=3, mode="plain", output_prefix=prefix, resume=True)
    assert again.resumed_from == 2 and [it.rows for it in again.iterations][:2] == [it.rows for it in first.iterations]


def test_record_entries_are_only_added(spark, scratch):
    record = RunRecord(spark, scratch("record") + "/it")
    record.begin({"a": 1})
    with pytest.raises(FileExistsError):
        record.begin({"a": 2})
    open(f"{record.folder}/round1.v1", "w").write('{"iteration": 1, "ro')  # a driver lost while it wrote
    assert record.entry("round1") is None and record.resume({"a": 1}, 5) == []
    record.add("round1", {"iteration": 1})
    assert record.resume({"a": 1}, 5) == [{"iteration": 1}]
    assert sorted(f for f in os.listdir(record.folder) if not f.startswith(".")) == ["round1.v1", "round1.v2", "settings.v1"]
    with pytest.raises(ValueError):
        record.resume({"a": 3}, 5)


def test_numbers_and_totals_without_a_single_partition(spark):
    df = spark.range(5000).selectExpr("CAST((id * 7919) % 5000 AS INT) AS k", "id % 13 AS amount").repartition(6)
    numbered = number_rows(df, ["k"], "pos")
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert all(r.k == r.pos for r in numbered.collect())
    totals = {r.k: r.before for r in running_totals(df, ["k"], "amount").collect()}
    amounts = {r.k: r.amount for r in df.collect()}
    run = 0
    for k in range(5000):
        assert totals[k] == run
        run += amounts[k]
    assert number_rows(df.filter("k < 0"), ["k"]).count() == 0


def test_join_by_size_with_a_hot_key(spark):
    rows = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1), ("c", 2)], "k STRING, v INT")
    records = spark.createDataFrame([("a", 500, "hot"), ("b", 1, "cold"), ("c", 1, "cold"), ("d", 0, "none")], "k STRING, n BIGINT, t STRING")
    out = join_by_size(rows, records, "k", "n", hot_rows=100)
    assert out.columns == ["k", "v", "n", "t"]
    assert sorted(map(tuple, out.collect())) == sorted([("a", i, 500, "hot") for i in range(500)] + [("b", 1, 1, "cold"), ("c", 2, 1, "cold")])
    with pytest.raises(FAILS, match="no record"):
        join_by_size(rows, records.filter("k <> 'b'"), "k", "n", 100).collect()


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_centre_file_is_read_in_splits(spark, scratch, small_splits, end):
    d = scratch("splits")
    write_text(f"{d}/b.txt", end.join(f"{i},{-i}" for i in range(3000)) + end * 4)
    write_text(f"{d}/a.txt", f"7,7{end}8\t8")
    write_text(f"{d}/c.txt", end * 900)
    assert spark.read.text(f"{d}/b.txt").rdd.getNumPartitions() > 5
    got = [tuple(r) for r in read_centers(spark, f"{d}/*.txt").orderBy("rank").collect()]
    assert got == [(0, 7, 7), (1, 8, 8)] + [(i + 2, i, -i) for i in range(3000)]


def test_status_of_several_parts_and_outputs(spark, scratch, small_splits):
    d = scratch("status-parts")
    write_text(f"{d}/part-00000", "Has converged\n" + "".join(f"{i},1\n" for i in range(800)))
    write_text(f"{d}/part-00001", "9,9\n8,8\n")
    write_text(f"{d}/part-00002", "Has not converged\n5,5\n")
    rows = read_status_centers(spark, d).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(803))
    assert {r.status for r in rows[:802]} == {"Has converged"} and tuple(rows[802]) == ("Has not converged", 802, 5, 5)


def test_result_and_status_sinks_of_many_parts(spark, scratch, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).selectExpr("CAST(id AS INT) AS new_x", "CAST(1 AS INT) AS new_y", "CAST(id * 7 AS INT) AS old_x", "CAST(2 AS INT) AS old_y")
        for write, name in ((sinks.write_result, "result"), (lambda r, p, **k: sinks.write_status(r, "Has converged", p, **k), "status")):
            many, one = scratch(name), scratch(name)
            write(df, many)
            write(df, one, short=True)
            assert len([f for f in os.listdir(many) if f.startswith("part-")]) > 4
            assert len([f for f in os.listdir(one) if f.startswith("part-")]) == 1
            assert text_of(many) == text_of(one)
            lines = text_of(one).splitlines()[name == "status":]
            assert len(lines) == 3000
        assert [r.old_x for r in read_result(spark, scratch_of(spark, df, scratch)).orderBy("rank").collect()] == sorted((7 * i for i in range(3000)), key=lambda v: f"{v},2")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def scratch_of(spark, df, scratch):
    path = scratch("again")
    sinks.write_result(df, path)
    return path


def test_json_files_of_any_length(spark, scratch):
    pairs = [(i * 37 % 4001 - 2000, -i) for i in range(4000)]
    path = scratch("json")
    write_centers_json(centers_df(spark, pairs), path)
    import json

    assert [(c["x"], c["y"]) for c in json.loads(text_of(path))] == pairs
    assert [tuple(r) for r in read_centers_json(spark, path).orderBy("rank").collect()] == [(i, *p) for i, p in enumerate(pairs)]
    line = write_text(f"{scratch('one-line')}/a.json", '[{"x":1,"y":2}, {"x":3,"y":4}]')
    assert [tuple(r) for r in read_centers_json(spark, line).orderBy("rank").collect()] == [(0, 1, 2), (1, 3, 4)]
    none = scratch("json-empty")
    write_centers_json(centers_df(spark, pairs).limit(0), none)
    assert text_of(none) == "[]\n" and read_centers_json(spark, none).count() == 0


@pytest.mark.parametrize("as_table", [False, True])
def test_listing_deals_small_centres_together_and_splits_large_ones(spark, scratch, monkeypatch, as_table):
    monkeypatch.setattr(sinks, "PART_ROWS", 2000)
    rng = random.Random(2)
    k = 3000 if not as_table else 15_000
    rows = [(c, c % 7, i, i) for i in range(40_000) for c in (rng.randrange(k),)] + [(5, 5, i, 0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "center_x INT, center_y INT, x INT, y INT").repartition(8)
    path = scratch("dealt")
    assert isinstance(sinks._counted(df), list) != as_table
    sinks.write_assignments(df, path)
    sizes = [len(open(os.path.join(path, f)).read().splitlines()) for f in sorted(os.listdir(path)) if f.startswith("part-")]
    assert 25 <= len(sizes) <= 40 and max(sizes) < 4500
    keys = [re.match(r"[^\t]*", line)[0] for line in text_of(path).splitlines()]
    assert keys == sorted(f"{r[0]},{r[1]}" for r in rows)


def test_members_of_a_round_read_the_points_once(spark, scratch):
    pts = [(i * 31 % 101, i * 17 % 97) for i in range(300)]
    src = scratch("member-points")
    points_df(spark, pts).write.parquet(src)
    df = spark.read.parquet(src)
    ctr = [(10, 10), (80, 20), (10, 10), (50, 90), (500, 500)]
    res = fit(df, ctr, iterations=2)
    out = res.members(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    centers = [(r[0], r[1]) for r in brute.fit(pts, ctr, 1, "combined")[0]]
    moved = {(r[2], r[3]): (r[0], r[1], r[4]) for r in brute.fit(pts, ctr, 2, "combined")[1]}
    want = sorted((*c, *moved[c], x, y, f"({x},{y})") for x, y in pts for c in [brute.nearest(x, y, centers)])
    assert sorted(map(tuple, out.collect())) == want
    first = fit(df, ctr, iterations=1).members(df).count()
    assert first == 300
    with pytest.raises(ValueError):
        fit(df, ctr, iterations=1, mode="plain").members(df)


def test_scratch_tables_are_deleted_on_request(spark):
    t = number_rows(spark.range(10), ["id"])
    path = t.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert clear_scratch(spark) >= 1 and not os.path.exists(path)

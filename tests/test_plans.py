"""Physical plan shape: what a step costs in shuffles, joins and scanned columns."""

import re

from pyspark.sql import functions as F

from lloydflow import step
from lloydflow.operators.assign import assign
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.plans.workload import K5, lattice, points_l
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_step_has_one_shuffle_and_no_join(spark):
    plan = _plan(step(points_l(spark, SF_SMALL).select("x", "y"), K5))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin", "BroadcastHashJoin"):
        assert bad not in plan
    assert "Union" in plan and "LocalTableScan" in plan  # the seed rows


def test_step_scans_only_two_columns(spark):
    plan = _plan(step(points_l(spark, SF_SMALL).select("x", "y"), K5))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["l_extendedprice", "l_quantity"]


def test_assignment_is_narrow(spark):
    for centers in (K5, lattice(60)):
        plan = _plan(assign(points_l(spark, SF_SMALL), prepare_centers(centers)))
        assert "Exchange" not in plan and "Join" not in plan


def test_nearest_search_evaluated_once(spark):
    # no inferred isnotnull filter re-running the search
    plan = _plan(step(points_l(spark, SF_SMALL).select("x", "y"), K5))
    assert not re.search(r"\bFilter\b", plan.replace("DataFilters", "").replace("PushedFilters", "")
                         .replace("PartitionFilters", ""))
    plan = _plan(step(points_l(spark, SF_SMALL).select("x", "y"), lattice(60)))
    assert plan.count("ArrowEvalPython") == 1


def test_step_plan_size_constant_across_iterations(spark):
    pts = points_l(spark, SF_SMALL).select("x", "y")
    # expression ids and centre literals differ between rounds; the plan otherwise must not
    shapes = {re.sub(r"\d+", "0", _plan(step(pts, [(x + 7 * i, y) for x, y in K5], iteration=i + 1)))
              for i in range(3)}
    assert len(shapes) == 1


def test_fit_adds_no_shuffle_of_the_points(spark):
    from lloydflow.plans.lloyd import _step

    pts = points_l(spark, SF_SMALL).select("x", "y")
    plan = _step(pts, prepare_centers(K5), "combined", 1, "auto", "x", "y", None)._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" not in plan


def test_listing_parts_follow_the_clusters_sizes(spark, monkeypatch):
    from lloydflow.sources import sinks

    monkeypatch.setattr(sinks, "PART_ROWS", 200)
    wide = spark.range(0, 5000, numPartitions=24).selectExpr("CAST(id % 7 AS STRING) AS key", "id AS x", "id AS y")
    sizes = [(k, 0, 5000 // 7) for k in range(7)]
    wide = wide.withColumn("key", F.concat("key", F.lit(",0")))
    out = sinks._sorted(wide, "key", sizes)
    # 714 lines ahead of each next centre, 200 to a part: the last begins in part 21 and takes four
    assert out.rdd.getNumPartitions() == 6 * 714 // 200 + 4  # by the clusters' sizes, not spark.sql.shuffle.partitions
    parts = out.rdd.glom().collect()
    assert [r.key for p in parts for r in p] == sorted(r.key for p in parts for r in p)
    assert all([(r.key, r.x) for r in p] == sorted((r.key, r.x) for r in p) for p in parts)
    assert max(map(len, parts)) < 2 * 200 + 100

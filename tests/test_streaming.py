"""Streaming: the running step keeps per-centre state across restarts from its checkpoint."""

import numpy as np

from lloydflow import step
from lloydflow.plans.lloyd import prepare_centers
from lloydflow.streaming import assign_stream, read_table_stream, running_step, write_stream
from tests import brute

SCHEMA = "x INT, y INT"
CENTERS = [(0, 0), (300, 300), (-300, 200)]


def _batch(seed, n=500):
    rng = np.random.default_rng(seed)
    return [tuple(int(v) for v in p) for p in rng.integers(-400, 400, size=(n, 2))]


def test_running_step_resumes_from_checkpoint(spark, scratch):
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    first, second = _batch(1), _batch(2)
    spark.createDataFrame(first, SCHEMA).write.parquet(f"{src}/batch=1")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = read_table_stream(spark, f"{src}/*", schema)
        running_step(stream, CENTERS, out, mode="plain", checkpoint=ck).awaitTermination()
        return sorted((r.new_x, r.new_y, r.old_x, r.old_y, r.n_points) for r in spark.read.parquet(out).collect())

    assert run() == sorted(brute.step(first, CENTERS, "plain"))
    spark.createDataFrame(second, SCHEMA).write.parquet(f"{src}/batch=2")
    got = run()  # restarted query: only the new file is read, the state holds the rest
    assert got == sorted(brute.step(first + second, CENTERS, "plain"))
    batch = step(spark.createDataFrame(first + second, SCHEMA), CENTERS, "plain").collect()
    assert got == sorted((r.new_x, r.new_y, r.old_x, r.old_y, r.n_points) for r in batch)


def test_assign_stream_appends_every_point(spark, scratch):
    src, out = scratch("src"), scratch("out")
    pts = _batch(3, 300)
    spark.createDataFrame(pts, SCHEMA).write.parquet(src)
    stream = read_table_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    write_stream(assign_stream(stream, CENTERS), out).awaitTermination()
    got = sorted((r.center_x, r.center_y, r.x, r.y) for r in spark.read.parquet(out).collect())
    assert got == brute.assignment(pts, [c[1:] for c in prepare_centers(CENTERS)])

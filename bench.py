"""Benchmark: headline clustering queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"};
each query's figure is the median of $BENCH_REPEATS (default 3) runs.
Each query runs to completion (``noop`` sink for row-per-point outputs, collect
for centre-sized ones).  A warm-up runs one step of each assignment form on the
small customer table first, so JVM and Python-worker start-up are not billed to
whichever query happens to come first.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from lloydflow.operators.assign import assign  # noqa: E402
from lloydflow.plans.lloyd import fit, prepare_centers, step  # noqa: E402
from lloydflow.plans.workload import K5, lattice, points_c, points_e, points_l  # noqa: E402
from lloydflow.session import local_session, scratch_path  # noqa: E402
from lloydflow.sources.sinks import write_assignments  # noqa: E402
from lloydflow.sources.points import collapse_points  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))  # each query's median over this many runs
KE = [(-2, 10), (0, 100), (2, 300)]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, app="lloydflow-bench")
    spark.sparkContext.setLogLevel("ERROR")
    L = points_l(spark, SF_DIR).select("x", "y")
    C = points_c(spark, SF_DIR).select("x", "y")
    E = points_e(spark, SF_DIR).select("x", "y")
    cores = int(CPUS)  # lineitem is a single row group here: the runs of several rounds deal it out once
    k30 = lattice(30)
    k100 = lattice(100)
    k1000 = lattice(1000, cols=40, x0=-1000, dx=300, y0=0, dy=400)

    wide = spark.range(15_000).selectExpr("CAST(id AS INT) AS rank", "CAST((id * 7919) % 11000 AS INT) AS x", "CAST((id * 104729) % 10100 AS INT) AS y")

    step(C, K5).collect()  # warm-up: codegen form
    step(C, k100).collect()  # warm-up: vectorised form (Python workers)

    runs = {
        "step_combined_L_k5": lambda: step(L, K5, "combined").collect(),
        "step_plain_L_k5": lambda: step(L, K5, "plain").collect(),
        "step_plain_E_sentinel": lambda: step(E, KE, "plain").collect(),
        "step_collapsed_E": lambda: step(collapse_points(E), KE, "plain", weight="weight").collect(),
        "step_combined_L_k30": lambda: step(L, k30, "combined").collect(),
        "step_combined_L_k100": lambda: step(L, k100, "combined").collect(),
        "step_combined_L_k1000": lambda: step(L, k1000, "combined").collect(),
        "step_combined_L_k1000_far": lambda: step(L, [(-9_000_000, -9_000_000), *k1000[1:]], "combined").collect(),
        **{f"assign_L_k{k}": (lambda c: lambda: drain(assign(L, prepare_centers(c))))(lattice(k)) for k in (24, 28, 32, 40)},
        "write_listing_L_k5": lambda: write_assignments(assign(L, prepare_centers(K5)), scratch_path(spark, "bench-listing")),
        "step_table_L_k15000": lambda: step(L, wide).collect(),
        "assign_L_k5": lambda: drain(assign(L, prepare_centers(K5))),
        "fit_fixed_plain_L_R5": lambda: fit(L, K5, iterations=5, mode="plain", partitions=cores),
        "fit_fixed_combined_L_R5": lambda: fit(L, K5, iterations=5, mode="combined", partitions=cores),
        "fit_fixed_combined_L_k100_R3": lambda: fit(L, k100, iterations=3, mode="combined", partitions=cores),
        "fit_stop_any_C_R10": lambda: fit(C, K5, iterations=10, mode="plain", stop="any"),
        "fit_stop_all_L_R10": lambda: fit(L, K5, iterations=10, mode="plain", stop="all", partitions=cores),
        "fit_status_L_R3": lambda: fit(L, K5, iterations=3, mode="combined", partitions=cores).status_rows().collect(),
        "fit_final_assignment_L_R3": lambda: drain(fit(L, K5, iterations=3, mode="combined", partitions=cores).assignment(L)),
    }
    times = {}
    for name, run in runs.items():
        samples = []
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            run()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    sf = float(m.group(1)) if m else SF_DIR
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

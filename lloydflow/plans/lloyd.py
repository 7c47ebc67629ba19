"""Lloyd iterations (I1–I7): one step as a DataFrame, and the driver loop.

A step is one Spark job: nearest-centre rank (narrow projection, centres bound
as literals) → UNION ALL with one seed row per centre → partial aggregate per
task → exchange of ≤ k rows per task → final aggregate.  The loop collects the k
result rows, orders them by old-centre text (the reference's output order,
which decides the next iteration's ranks) and binds them as the next literals.
Plans therefore stay the same size every round and lineage never grows; the
points are persisted once and recomputed from the source if an executor is lost.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import IN_PLAN_CENTERS, MODES, STABILITY_THRESHOLD, STATUS_CONVERGED
from ..operators.aggregate import finalize_stats, members, seeded_stats
from ..operators.assign import assign, assign_rank
from ..operators.convergence import status_of
from ..operators.ordering import text_key
from ..sources.centers import as_center_list, centers_frame, is_table, ranked_distinct
from ..sources.points import collapse_points
from ..session import delete_path, local_frame, scratch_path
from ..sources.sinks import iteration_path, write_assignments, write_result, write_status
from .large import TableFitResult, fit_table, step_table
from .record import RunRecord

STOP_RULES = ("none", "any", "all")

RESULT_SCHEMA = "iteration INT, pos INT, new_x INT, new_y INT, old_x INT, old_y INT, n_points BIGINT"
STATUS_SCHEMA = "iteration INT, status STRING, rank INT, x INT, y INT"
HISTORY_SCHEMA = ("iteration INT, k INT, n_points BIGINT, max_move BIGINT, n_stable INT, status STRING, "
                  "seconds DOUBLE")


def prepare_centers(centers, most: int = IN_PLAN_CENTERS) -> list[tuple[int, int, int]]:
    """Centres (DataFrame ``rank, x, y`` of at most ``most`` rows, or ``(x, y)`` pairs) → distinct ``(rank, x, y)``."""
    return ranked_distinct(as_center_list(centers, most))


def _step(points: DataFrame, ranked: Sequence[tuple[int, int, int]], mode: str, iteration: int, strategy: str,
          x: str, y: str, weight: str | None) -> DataFrame:
    cols = [x, y] + ([weight] if weight else [])
    assigned = assign_rank(points.select(*cols), ranked, x, y, strategy)
    stats = seeded_stats(assigned, centers_frame(points.sparkSession, ranked), mode, x=x, y=y, weight=weight)
    return finalize_stats(stats, mode).selectExpr(
        f"CAST({int(iteration)} AS INT) AS iteration", "rank", "new_x", "new_y", "old_x", "old_y", "n_points")


def step(points: DataFrame, centers, mode: str = "combined", iteration: int = 1, strategy: str = "auto",
         x: str = "x", y: str = "y", weight: str | None = None, in_plan: int = IN_PLAN_CENTERS) -> DataFrame:
    """One Lloyd step → ``iteration, rank, new_x, new_y, old_x, old_y, n_points``.

    One row per distinct old centre (equal centres collapse, the first keeps its
    rank); an empty cluster keeps its centre.  ``mode`` picks the reference's
    plain or combiner semantics (they differ on x = -1 points and zero x-sums).
    A DataFrame of more than ``in_plan`` centres stays a table (``plans.large``).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be 'plain' or 'combined', got {mode!r}")
    if is_table(centers, in_plan):
        return step_table(points, centers, mode, iteration, x, y, weight)
    return _step(points, prepare_centers(centers, in_plan), mode, iteration, strategy, x, y, weight)


@dataclass
class Iteration:
    """One finished iteration, as collected by the loop (k rows in output order)."""

    iteration: int
    rows: list[tuple[int, int, int, int, int]]  # new_x, new_y, old_x, old_y, n_points
    status: str
    max_move: int
    n_stable: int
    seconds: float

    @property
    def new_centers(self) -> list[tuple[int, int]]:
        return [(r[0], r[1]) for r in self.rows]


@dataclass
class FitResult:
    """What a run produced: every iteration's rows, statuses and timings."""

    spark: SparkSession
    mode: str
    stop: str
    threshold: int
    iterations: list[Iteration] = field(default_factory=list)
    points_read: DataFrame | None = None  # the (x, y[, weight]) rows each round reads
    resumed_from: int = 0  # last round read back by fit(resume=True), 0 if none
    started_from: list[tuple[int, int, int]] = field(default_factory=list)  # the seed centres, ranked and distinct

    @property
    def iterations_run(self) -> int:
        return len(self.iterations)

    @property
    def last_iteration(self) -> int:
        return self.iterations[-1].iteration if self.iterations else 0

    @property
    def final_centers(self) -> list[tuple[int, int, int]]:
        """Ranked distinct centres after the last iteration (its new centres, in output order)."""
        return ranked_distinct(self.iterations[-1].new_centers)

    @property
    def searched(self) -> list[tuple[int, int, int]]:
        """Ranked distinct centres that the last iteration assigned points to."""
        return ranked_distinct(self.iterations[-2].new_centers) if len(self.iterations) > 1 else self.started_from

    @property
    def converged(self) -> bool:
        return self.iterations[-1].status == STATUS_CONVERGED

    def results(self) -> DataFrame:
        """All iterations' ``(new, old)`` rows with their output position."""
        rows = [(it.iteration, pos, *r) for it in self.iterations for pos, r in enumerate(it.rows)]
        return local_frame(self.spark, rows, RESULT_SCHEMA)

    def result(self) -> DataFrame:
        """The last iteration's rows — what the reference leaves in its last output."""
        return self.results().filter(F.col("iteration") == self.last_iteration)

    def status_rows(self) -> DataFrame:
        """Per iteration the status and the new centres (the status-headed files)."""
        rows = [(it.iteration, it.status, pos, r[0], r[1]) for it in self.iterations for pos, r in enumerate(it.rows)]
        return local_frame(self.spark, rows, STATUS_SCHEMA)

    def history(self) -> DataFrame:
        """I8: one row per iteration — k, points, largest move, stable centres, status, seconds."""
        rows = [
            (it.iteration, len(it.rows), sum(r[4] for r in it.rows), it.max_move, it.n_stable, it.status, it.seconds)
            for it in self.iterations
        ]
        return local_frame(self.spark, rows, HISTORY_SCHEMA)

    def sizes(self) -> list[tuple[int, int, int]]:
        """``(x, y, points)`` per final centre, as counted in the last round."""
        n: dict[tuple[int, int], int] = {}
        for new_x, new_y, _, _, points in self.iterations[-1].rows:
            n[new_x, new_y] = n.get((new_x, new_y), 0) + points
        return [(x, y, c) for (x, y), c in n.items()]

    def members(self, points: DataFrame, keep: Sequence[str] = (), x: str = "x", y: str = "y", strategy: str = "auto") -> DataFrame:
        """A5: the last round's clusters with their members, in one pass over the points.

        The averages are those that the round computed (a combined round moves every centre with
        points to its truncated mean), so only the listing itself reads the points.
        """
        if self.mode != "combined":
            raise ValueError("only a combined round's new centres are the averages of all members")
        moved = {(ox, oy): (nx, ny, n) for nx, ny, ox, oy, n in self.iterations[-1].rows}
        averages = [(rank, *moved[cx, cy]) for rank, cx, cy in self.searched]
        assigned = assign(points, self.searched, x, y, strategy)
        return members(assigned, x, y, keep, local_frame(self.spark, averages, "center_rank INT, avg_x INT, avg_y INT, n_members BIGINT"))

    def assignment(self, points: DataFrame, x: str = "x", y: str = "y", strategy: str = "auto") -> DataFrame:
        """Every point with its centre among the final centres (no empty centres)."""
        return assign(points, self.final_centers, x, y, strategy)


def fit(points: DataFrame, centers, iterations: int = 1, mode: str = "combined", stop: str = "none",
        threshold: int = STABILITY_THRESHOLD, strategy: str = "auto", x: str = "x", y: str = "y",
        weight: str | None = None, persist: bool | str = True, output_prefix: str | None = None,
        status_files: bool = False, final_listing: bool = False, collapse: bool = False,
        resume: bool = False, in_plan: int = IN_PLAN_CENTERS, partitions: int | None = None) -> FitResult | TableFitResult:
    """Run Lloyd iterations under one of the reference's policies.

    * ``stop="none"`` — exactly ``iterations`` rounds (I2 plain, I5 combined).
    * ``stop="any"`` — stop after the first round ≥ 2 in which some centre is stable (I3).
    * ``stop="all"`` — stop after the first round in which every centre is stable (I4).

    Every round gets a status (I6).  With ``output_prefix`` each round is written
    to ``prefix + r`` — result lines, or status-headed centre lines when
    ``status_files`` — and with ``final_listing`` the point listing goes to
    ``prefix + "Final"`` (I7, S9).

    ``persist`` decides how the R passes read the points: ``True`` / ``"cache"``
    keeps the projected points in memory and disk (lost blocks are recomputed
    from the source); ``"table"`` writes them once as parquet under the shared
    ``spark.checkpoint.dir`` folder and reads that table every round — lineage
    cut, nothing to recompute if an executor is lost, best for expensive sources
    such as large text inputs; ``False`` re-reads the source every round.

    ``collapse=True`` first merges equal points into ``(x, y, weight)`` (one
    partially aggregated shuffle) and runs every round over distinct points —
    exact, and much less work on very repetitive integer data.  The final
    listing still lists every original point.

    ``partitions`` deals the points anew over so many partitions before they are kept: one
    shuffle that pays when the source has fewer splits than the cluster has cores (a
    single Parquet row group, a compressed text file) and several rounds follow.

    Every round is computed, also at a fixed point: R rounds give R measured times.

    ``resume=True`` (with ``output_prefix``) restarts a run whose driver was lost.
    Beside the rounds a run keeps a record (folder ``prefix + "Run"``): its settings and
    seed centres, and every round's rows once its output is written.  The rounds on
    record are taken over with their figures, and the next one follows; a run that
    had already stopped does no further round.  A record of other settings or
    centres is refused, and so are rounds without a record; a start without ``resume`` on a
    prefix that already holds a run is refused before anything is written (``RunRecord``).  ``FitResult.iterations`` holds all
    rounds; ``resumed_from`` is the last one taken over.

    A DataFrame of more than ``in_plan`` centres stays a table: rounds and results are
    tables too, only figures come to the driver, and a ``TableFitResult`` is returned.
    ``strategy`` has no meaning there.
    """
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    if mode not in MODES:
        raise ValueError(f"mode must be 'plain' or 'combined', got {mode!r}")
    if stop not in STOP_RULES:
        raise ValueError(f"stop must be one of {STOP_RULES}, got {stop!r}")
    if persist not in (True, False, None, "cache", "table"):
        raise ValueError(f"persist must be True, False, 'cache' or 'table', got {persist!r}")
    table_form = is_table(centers, in_plan)
    ranked = [] if table_form else prepare_centers(centers, in_plan)
    spark = points.sparkSession
    source = points
    if collapse:
        if weight:
            raise ValueError("collapse=True computes its own weights; pass either weight or collapse")
        source = collapse_points(points.select(x, y), x, y)
        weight = "weight"
    cols = [x, y] + ([weight] if weight else [])
    pts = source.select(*cols).repartition(partitions) if partitions else source.select(*cols)
    out = FitResult(spark, mode, stop, threshold, started_from=ranked)
    out.points_read = pts
    first = 1
    settings = {"mode": mode, "stop": stop, "threshold": threshold, "status_files": status_files, "collapse": collapse}
    if resume and output_prefix is None:
        raise ValueError("resume needs the output_prefix of the interrupted run")
    if table_form:
        with _kept(pts, persist) as kept:
            return fit_table(kept, points.select(x, y) if collapse else kept.select(x, y), centers, iterations, mode, stop, threshold,
                             x, y, weight, settings, output_prefix, status_files, final_listing, resume)
    settings["centers"] = [list(c) for c in ranked]
    if resume:
        record = RunRecord(spark, output_prefix)
        out.iterations = [_iteration(e["iteration"], [tuple(x) for x in e["rows"]], threshold, e["seconds"])
                          for e in record.resume(settings, iterations)]
        if out.iterations:
            last = out.iterations[-1]
            out.resumed_from, first = last.iteration, last.iteration + 1
            ranked = out.final_centers
            if _stops(stop, last):
                first = iterations + 1
    elif output_prefix is not None:
        record = RunRecord(spark, output_prefix)
        record.begin(settings)
    dealt = pts
    with _kept(dealt, persist) as pts:
        out.points_read = pts
        for r in range(first, iterations + 1):
            t0 = time.perf_counter()
            collected = _step(pts, ranked, mode, r, strategy, x, y, weight).collect()
            collected.sort(key=lambda row: text_key(row["old_x"], row["old_y"]))
            rows = [(row["new_x"], row["new_y"], row["old_x"], row["old_y"], row["n_points"])
                    for row in collected]
            it = _iteration(r, rows, threshold, time.perf_counter() - t0)
            out.iterations.append(it)
            if output_prefix is not None:
                # a resumed run replaces a round folder left unfinished by the lost driver
                _write_iteration(out, it, iteration_path(output_prefix, r), status_files,
                                 "overwrite" if resume else "errorifexists")
                record.add(f"round{r}", {"iteration": r, "rows": [list(x) for x in rows], "seconds": it.seconds})
            ranked = ranked_distinct(it.new_centers)
            if _stops(stop, it):
                break
        if output_prefix is not None and final_listing:
            # The listing needs every original point: the kept copy has them unless
            # equal points were merged, in which case the source is read again.
            listed = points.select(x, y) if collapse else pts.select(x, y)
            write_assignments(out.assignment(listed, x, y, strategy), iteration_path(output_prefix, "Final"),
                              mode="overwrite" if resume else "errorifexists", sizes=out.sizes())
    out.points_read = dealt
    return out


@contextmanager
def _kept(points: DataFrame, persist: bool | str | None):
    """The points as the rounds read them (see ``fit``), for as long as they run."""
    spark = points.sparkSession
    if persist in (True, "cache"):
        # Kept as read: the scan's split settings decide the parallelism, without a shuffle.
        kept = points.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield kept
        finally:
            kept.unpersist()
    elif persist:
        path = scratch_path(spark, "points")
        points.write.parquet(path)
        try:
            yield spark.read.parquet(path)
        finally:
            delete_path(spark, path)
    else:
        yield points


def _iteration(r: int, rows: list[tuple[int, int, int, int, int]], threshold: int, seconds: float) -> Iteration:
    moves = [max(abs(nx - ox), abs(ny - oy)) for nx, ny, ox, oy, _ in rows]
    return Iteration(r, rows, status_of(moves, threshold), max(moves), sum(1 for m in moves if m < threshold), seconds)


def _stops(stop: str, it: Iteration) -> bool:
    """Whether a run under the rule ends after this round."""
    return (stop == "any" and it.iteration >= 2 and it.n_stable > 0) or (stop == "all" and it.n_stable == len(it.rows))


def _write_iteration(fit_result: FitResult, it: Iteration, path: str, status_files: bool, mode: str) -> None:
    rows = [(it.iteration, pos, *r) for pos, r in enumerate(it.rows)]
    df = local_frame(fit_result.spark, rows, RESULT_SCHEMA)
    if status_files:
        write_status(df, it.status, path, mode=mode, short=True)
    else:
        write_result(df, path, mode=mode, short=True)

"""Lloyd iterations over a table of centres (I1–I7 beyond what a plan can carry).

No centre row comes to the driver.  A round searches through a ``TileIndex`` of its centres,
writes its result (k rows, numbered in centre-text order) as a table, and reads
one row of figures back: number of centres, points, largest move, stable centres.
Stop rules, statuses and the history follow from those; the next round's centres are the
written table again.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.average import keep_or_move
from ..functions.constants import STATUS_CONVERGED, STATUS_NOT_CONVERGED
from ..operators.convergence import with_movement
from ..operators.ordering import rank_by_center_text
from ..operators.tiles import TileIndex, assign_table, build_index, stats_table
from ..session import local_frame, scratch_table, written
from ..sources.centers import collapse_centers, ranked_table
from ..sources.sinks import iteration_path, write_assignments, write_result, write_status
from .record import RunRecord

HISTORY_SCHEMA = ("iteration INT, k INT, n_points BIGINT, max_move BIGINT, n_stable INT, status STRING, "
                  "seconds DOUBLE")
RESULT_COLUMNS = ["pos", "new_x", "new_y", "old_x", "old_y", "n_points"]


def result_table(points: DataFrame, centers: DataFrame, index: TileIndex, mode: str, x: str, y: str, weight: str | None) -> DataFrame:
    """J2 + F9: every centre with its statistics → ``rank, new_x, new_y, old_x, old_y, n_points``."""
    stats = stats_table(points, index, mode, x, y, weight)
    joined = centers.join(stats, centers["rank"] == stats["center_rank"], "left")
    return joined.select("rank", keep_or_move(mode, "x", "sum_x").alias("new_x"), keep_or_move(mode, "y", "sum_y").alias("new_y"),
                         F.col("x").alias("old_x"), F.col("y").alias("old_y"), F.coalesce("n_points", F.lit(0)).alias("n_points"))


def step_table(points: DataFrame, centers: DataFrame, mode: str, iteration: int, x: str, y: str, weight: str | None) -> DataFrame:
    """I1 over a table of centres → ``iteration, rank, new_x, new_y, old_x, old_y, n_points``."""
    ranked = ranked_table(centers)
    out = result_table(points, ranked, build_index(ranked), mode, x, y, weight)
    return out.select(F.lit(int(iteration)).cast("int").alias("iteration"), "*")


@dataclass
class TableRound:
    """The figures of one finished round and where its rows are."""

    iteration: int
    k: int
    n_points: int
    max_move: int
    n_stable: int
    seconds: float
    table: str

    @property
    def status(self) -> str:
        return STATUS_CONVERGED if self.n_stable == self.k else STATUS_NOT_CONVERGED

    def stops(self, rule: str) -> bool:
        """Whether a run under the rule ends after this round."""
        return (rule == "any" and self.iteration >= 2 and self.n_stable > 0) or (rule == "all" and self.n_stable == self.k)


@dataclass
class TableFitResult:
    """What a run over a table of centres produced; its rows stay in tables."""

    spark: SparkSession
    mode: str
    stop: str
    threshold: int
    iterations: list[TableRound] = field(default_factory=list)
    resumed_from: int = 0

    @property
    def iterations_run(self) -> int:
        return len(self.iterations)

    @property
    def last_iteration(self) -> int:
        return self.iterations[-1].iteration if self.iterations else 0

    @property
    def converged(self) -> bool:
        return self.iterations[-1].status == STATUS_CONVERGED

    def rows(self, r: TableRound) -> DataFrame:
        """One round's ``iteration, pos, new_x, new_y, old_x, old_y, n_points``."""
        return self.spark.read.parquet(r.table).select(F.lit(r.iteration).cast("int").alias("iteration"), *RESULT_COLUMNS)

    def results(self) -> DataFrame:
        """All rounds' rows."""
        out = self.rows(self.iterations[0])
        for r in self.iterations[1:]:
            out = out.unionByName(self.rows(r))
        return out

    def result(self) -> DataFrame:
        """The last round's rows."""
        return self.rows(self.iterations[-1])

    def status_rows(self) -> DataFrame:
        """Per round the status and the new centres."""
        status = local_frame(self.spark, [(r.iteration, r.status) for r in self.iterations], "iteration INT, status STRING")
        return self.results().join(F.broadcast(status), "iteration").select(
            "iteration", "status", F.col("pos").alias("rank"), F.col("new_x").alias("x"), F.col("new_y").alias("y"))

    def history(self) -> DataFrame:
        """I8: one row per round."""
        rows = [(r.iteration, r.k, r.n_points, r.max_move, r.n_stable, r.status, r.seconds) for r in self.iterations]
        return local_frame(self.spark, rows, HISTORY_SCHEMA)

    @property
    def final_centers(self) -> DataFrame:
        """``rank, x, y`` after the last round: its new centres in output order, equal ones merged."""
        return next_state(self.result())

    def index(self) -> TileIndex:
        """The search index of the final centres."""
        return build_index(written(self.final_centers, "final-centres"))

    def sizes(self) -> DataFrame:
        """``x, y, points`` per final centre, as counted in the last round."""
        return self.result().groupBy(F.col("new_x").alias("x"), F.col("new_y").alias("y")).agg(F.sum("n_points").alias("points"))

    def assignment(self, points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
        """Every point with its centre among the final centres."""
        return assign_table(points, self.index(), x, y)


def next_state(result: DataFrame) -> DataFrame:
    """The next round's ``rank, x, y``: new centres by output position, the first of equal ones."""
    return collapse_centers(result.select(F.col("pos").alias("rank"), F.col("new_x").alias("x"), F.col("new_y").alias("y")))


def fingerprint(centers: DataFrame) -> list:
    """Number and order-free hash of ranked centres, to tell whether a run had the same."""
    h = F.xxhash64("rank", "x", "y").cast("decimal(38,0)")
    n, total = centers.agg(F.count(F.lit(1)), F.sum(h)).first()
    return [int(n), str(total)]


def fit_table(points: DataFrame, source: DataFrame, centers: DataFrame, iterations: int, mode: str, stop: str, threshold: int,
              x: str, y: str, weight: str | None, settings: dict, output_prefix: str | None, status_files: bool,
              final_listing: bool, resume: bool) -> TableFitResult:
    """The rounds of ``fit`` over a table of centres; ``points`` is what rounds read, ``source`` what the listing lists."""
    spark = points.sparkSession
    state = ranked_table(centers)
    out = TableFitResult(spark, mode, stop, threshold)
    first, record = 1, None
    if output_prefix is not None:
        record = RunRecord(spark, output_prefix)
        settings = settings | {"centers": fingerprint(state)}
        if resume:
            out.iterations = [TableRound(**e) for e in record.resume(settings, iterations)]
        else:
            record.begin(settings)
    if out.iterations:
        last = out.iterations[-1]
        out.resumed_from, first = last.iteration, last.iteration + 1
        state = written(next_state(out.result()), "centres")
        if last.stops(stop):
            first = iterations + 1
    for r in range(first, iterations + 1):
        t0 = time.perf_counter()
        ranked = rank_by_center_text(result_table(points, state, build_index(state), mode, x, y, weight)).select(*RESULT_COLUMNS)
        # Beside the record under a name of its own for each try: what a lost driver left is not read.
        path = scratch_table(spark, f"round-{r}") if record is None else f"{record.folder}/table{r}-{int(time.time() * 1000)}"
        ranked.write.parquet(path)
        rows = spark.read.parquet(path)
        moved = with_movement(rows, threshold)
        k, n, move, stable = moved.agg(F.count(F.lit(1)), F.sum("n_points"), F.max("move"), F.count_if("stable")).first()
        done = TableRound(r, k, n, move, stable, time.perf_counter() - t0, path)
        out.iterations.append(done)
        if record is not None:
            write_mode = "overwrite" if resume else "errorifexists"
            if status_files:
                write_status(rows, done.status, iteration_path(output_prefix, r), mode=write_mode)
            else:
                write_result(rows, iteration_path(output_prefix, r), mode=write_mode)
            record.add(f"round{r}", done.__dict__)
        state = written(next_state(rows), "centres")
        if done.stops(stop):
            break
    if output_prefix is not None and final_listing:
        write_assignments(out.assignment(source, x, y), iteration_path(output_prefix, "Final"),
                          mode="overwrite" if resume else "errorifexists", sizes=out.sizes())
    return out

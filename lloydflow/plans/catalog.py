"""Named queries over the given tables — one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match
the oracle SQL of the same name (``plans/oracle.py``).  Every query reads whole
tables; centre sets are parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.average import merge_partials_agg, partials_equal
from ..functions.constants import STATUS_CONVERGED, STATUS_NOT_CONVERGED
from ..functions.geometry import center_text, distance, point_text
from ..operators.aggregate import finalize_partials, members, seeds
from ..operators.aggregate import merge_partials as merge_partials_op
from ..operators.aggregate import partials as partials_op
from ..operators.assign import assign, assign_rank
from ..operators.convergence import all_stable, any_stable, status_message, with_movement
from ..operators.ordering import rank_by_center_text
from ..operators.tiles import assign_table, build_index
from ..session import scratch_path
from ..sources.centers import (
    centers_frame,
    centers_from_json,
    centers_to_json,
    parse_center_lines,
    parse_result_lines,
    line_positions,
    parse_status_lines,
    ranked_table,
    read_centers,
    read_centers_json,
    read_result,
    read_status_centers,
    write_centers_json,
)
from ..sources.points import collapse_points, parse_point_lines, points_from, read_assignments, read_points
from ..sources.sinks import (
    assignment_lines,
    iteration_path,
    result_lines,
    status_lines,
    write_assignments,
    write_result,
)
from ..streaming.clusters import assign_stream, assign_stream_table, read_table_stream, running_step, write_stream
from .lloyd import fit, prepare_centers, step
from .workload import (
    K5,
    K5F,
    KDUP,
    KE,
    KROOT,
    KROOT_44,
    KT,
    LATTICE_60,
    LATTICE_200,
    LATTICE_1000F,
    MANY,
    centers_o,
    centers_s,
    points_c,
    points_e,
    points_l,
    points_s,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STEP_COLS = ["iteration", "rank", "new_x", "new_y", "old_x", "old_y", "n_points"]
RESULT_COLS = ["iteration", "pos", "new_x", "new_y", "old_x", "old_y", "n_points"]


def query(fn: Query | None = None, *, name: str | None = None):
    """Register a catalog query under its function name (or ``name``)."""
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# ---------------------------------------------------------------- sources S1–S5

@query
def points_projection(spark, d):
    return points_c(spark, d).select("c_custkey", "x", "y")


@query
def points_parse_text(spark, d):
    """S1 parser on lines Spark builds from customer: optional '+', extra fields."""
    p = points_c(spark, d)
    sign = F.when((F.col("c_custkey") % 2 == 0) & (F.col("x") >= 0), F.lit("+")).otherwise(F.lit(""))
    lines = p.select("c_custkey", F.concat(sign, _s("x"), F.lit(","), _s("y"), F.lit(","),
                                           F.col("c_custkey").cast("string"), F.lit(",extra")).alias("value"))
    return parse_point_lines(lines, keep=("c_custkey",))


@query
def points_file_roundtrip(spark, d):
    """S1 file reader: point lines written to the shared folder, read back."""
    path = scratch_path(spark, "points")
    p = points_c(spark, d)
    p.select(F.concat_ws(",", _s("x"), _s("y"), F.col("c_custkey").cast("string")).alias("value")).write.text(path)
    return read_points(spark, path)


@query
def centers_parse_text(spark, d):
    """S2 line parser: ``x<TAB>y`` and ``x,y`` lines with their positions."""
    p = points_c(spark, d)
    sep = F.when(F.col("c_custkey") % 2 == 1, F.lit("\t")).otherwise(F.lit(","))
    lines = p.select(F.col("c_custkey").alias("pos"), F.concat(_s("x"), sep, _s("y")).alias("line"))
    return parse_center_lines(lines)


@query
def centers_file_roundtrip(spark, d):
    """S2 end to end: a round's new centres written as an ``x<TAB>y`` file, read back as a seed file."""
    res = step(points_l(spark, d), K5, "combined")
    path = scratch_path(spark, "centres-file")
    (res.select(center_text("old_x", "old_y").alias("key"),
                F.concat_ws("\t", _s("new_x"), _s("new_y")).alias("value"))
     .repartition(1).sortWithinPartitions("key").select("value").write.text(path))
    return read_centers(spark, path)


@query
def status_centers_parse(spark, d):
    """S4 on documents: an order's status line, then its line items as centres."""
    orders = table(spark, d, "orders")
    head = orders.select(
        F.col("o_orderkey").alias("doc"), F.lit(0).alias("pos"),
        F.when(F.col("o_orderstatus") == "F", F.lit(STATUS_CONVERGED)).otherwise(F.lit(STATUS_NOT_CONVERGED))
        .alias("line"),
    )
    body = points_l(spark, d).select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("pos"),
        F.concat_ws(",", _s("x"), _s("y")).alias("line"),
    )
    return parse_status_lines(head.unionByName(body))


@query
def result_parse_pairs(spark, d):
    """``new<TAB>old`` four-integer lines."""
    p = points_l(spark, d)
    old_x = (F.col("x") + F.col("l_linenumber") * 7 - 20).cast("int")
    old_y = (F.col("y") - F.col("l_suppkey") % 50).cast("int")
    lines = p.select(
        "l_orderkey", F.col("l_linenumber").alias("pos"),
        F.concat(_s("x"), F.lit(","), _s("y"), F.lit("\t"), _s(old_x), F.lit(","), _s(old_y)).alias("line"),
    )
    return parse_result_lines(lines, keep=("l_orderkey",))


# ---------------------------------------------------------------- JSON S10

def _step_l_k5(spark, d):
    return step(points_l(spark, d), K5, "combined")


@query
def centers_json_export(spark, d):
    res = _step_l_k5(spark, d).withColumn("order_key", center_text("old_x", "old_y"))
    return centers_to_json(res, rank="order_key", x="new_x", y="new_y")


@query
def centers_json_import(spark, d):
    return centers_from_json(centers_json_export(spark, d))


# ---------------------------------------------------------------- functions F1–F3

@query
def distance_matrix(spark, d):
    p = points_c(spark, d)
    return p.select("c_custkey", "x", "y", *[distance("x", "y", cx, cy).alias(f"dist_{i}") for i, (cx, cy) in
                                             enumerate(K5)])


@query
def center_and_point_text(spark, d):
    a = assign(points_c(spark, d), prepare_centers(K5))
    return a.select("c_custkey", point_text("x", "y").alias("point_text"),
                    center_text("center_x", "center_y").alias("center_text"))


# ---------------------------------------------------------------- assignment J1/J3

def _assign(points: DataFrame, centers, keys, strategy="auto") -> DataFrame:
    a = assign(points, prepare_centers(centers), strategy=strategy)
    return a.select(*keys, "x", "y", "center_rank", "center_x", "center_y")


@query
def assign_nearest(spark, d):
    return _assign(points_l(spark, d), K5, ["l_orderkey", "l_linenumber"])


@query
def assign_vectorized(spark, d):
    return _assign(points_l(spark, d), K5, ["l_orderkey", "l_linenumber"], strategy="vectorized")


@query
def assign_tie_first(spark, d):
    return _assign(points_e(spark, d), KT, ["event_id"])


@query
def assign_large_k(spark, d):
    return _assign(points_c(spark, d), LATTICE_60, ["c_custkey"])


# ---------------------------------------------------------------- one step I1

@query
def step_plain(spark, d):
    return step(points_l(spark, d), K5, "plain").select(*STEP_COLS)


@query
def step_combined(spark, d):
    return step(points_l(spark, d), K5, "combined").select(*STEP_COLS)


@query
def step_plain_sentinel(spark, d):
    return step(points_e(spark, d), KE, "plain").select(*STEP_COLS)


@query
def step_combined_sentinel(spark, d):
    return step(points_e(spark, d), KE, "combined").select(*STEP_COLS)


@query
def step_collapsed_sentinel(spark, d):
    """The plain step over equal points collapsed to weights — same result."""
    return step(collapse_points(points_e(spark, d)), KE, "plain", weight="weight").select(*STEP_COLS)


@query
def step_large_k(spark, d):
    return step(points_c(spark, d), LATTICE_60, "combined").select(*STEP_COLS)


@query
def step_grid_k200(spark, d):
    """200 lattice centres over lineitem: the vectorised search with its candidate grid."""
    return step(points_l(spark, d), LATTICE_200, "combined").select(*STEP_COLS)


@query
def preserve_empty(spark, d):
    return step(points_c(spark, d), K5F, "combined").select(*STEP_COLS)


@query
def dup_centers_collapse(spark, d):
    return step(points_c(spark, d), KDUP, "combined").select(*STEP_COLS)


@query
def assign_root_ties(spark, d):
    """Distances that tie only after the root, in whole-stage code."""
    return _assign(points_s(spark, d), KROOT, ["c_custkey"])


@query
def assign_root_ties_vectorized(spark, d):
    return _assign(points_s(spark, d), KROOT_44, ["c_custkey"])


@query
def step_far_center(spark, d):
    """A thousand centres, one of them far away and empty."""
    return step(points_c(spark, d), LATTICE_1000F)


@query
def step_many_centers(spark, d):
    """One centre per order: the centres stay a table."""
    return step(points_c(spark, d), centers_o(spark, d), in_plan=MANY)


@query
def step_many_centers_plain(spark, d):
    """As many centres as lineitem points are dealt to, with a sentinel mean."""
    return step(points_l(spark, d), centers_s(spark, d), "plain", in_plan=0)


@query
def assign_many_centers(spark, d):
    """Every point with its centre among a table of centres, through a tile index."""
    index = build_index(ranked_table(centers_o(spark, d)), per_tile=500)
    a = assign_table(points_c(spark, d), index)
    return a.select("c_custkey", "x", "y", "center_rank", "center_x", "center_y")


@query
def distance_to_center(spark, d):
    """Every point's distance to the centre it is assigned to."""
    a = assign(points_c(spark, d), prepare_centers(K5))
    return a.select("c_custkey", F.expr("sqrt(pow(CAST(x AS DOUBLE) - center_x, 2) + pow(CAST(y AS DOUBLE) - center_y, 2))")
                    .alias("dist"))


# ---------------------------------------------------------------- partials A2–A4

def _split_assigned(spark, d):
    ranked = prepare_centers(K5)
    pts = points_l(spark, d).withColumn("split", (F.col("l_orderkey") % 8).cast("int"))
    return ranked, assign_rank(pts, ranked)


@query(name="partials")
def partials_query(spark, d):
    _, a = _split_assigned(spark, d)
    return partials_op(a, ["split"]).select("split", "center_rank", "sum_x", "sum_y", "n", "only_seed")


@query(name="merge_partials")
def merge_partials_query(spark, d):
    ranked, a = _split_assigned(spark, d)
    merged = merge_partials_op(partials_op(a, ["split"]), centers_frame(spark, ranked))
    return merged.select(F.lit(1).alias("iteration"), "rank", "new_x", "new_y", "old_x", "old_y", "n_points")


@query
def merge_partials_plain_sentinel(spark, d):
    """Plain-mode partials: sentinel points count as points, not in the mean."""
    ranked = prepare_centers(KE)
    a = assign_rank(points_e(spark, d).withColumn("split", (F.col("event_id") % 8).cast("int")), ranked)
    merged = merge_partials_op(partials_op(a, ["split"], "plain"), centers_frame(spark, ranked), "plain")
    return merged.select(F.lit(1).alias("iteration"), "rank", "new_x", "new_y", "old_x", "old_y", "n_points")


@query
def partials_evaluation(spark, d):
    """A4 over lineitem: zero elements alone, averages of merged partials, and equality of partials."""
    _, a = _split_assigned(spark, d)
    merged = partials_op(a, []).select("center_rank", "sum_x", "sum_y", "n", "only_seed")
    zero = seeds(centers_frame(spark, prepare_centers(K5))).withColumn("center_rank", F.col("center_rank") + 100)
    both = finalize_partials(zero.unionByName(merged).groupBy("center_rank").agg(*merge_partials_agg()))
    pair = both.withColumn("a", F.struct("sum_x", "sum_y", "n")).withColumn(
        "b", F.struct("sum_x", "sum_y", (F.col("n") + F.when(F.col("center_rank") % 2 == 0, 0).otherwise(1)).alias("n")))
    return pair.select("center_rank", "n", "only_seed", "avg_x", "avg_y", partials_equal("a", "b").alias("same"))


# ---------------------------------------------------------------- members A5

@query
def members_list(spark, d):
    """The members of a round's clusters, with the averages that the round computed."""
    pts = points_c(spark, d)
    return fit(pts, K5, iterations=1).members(pts, keep=("c_custkey",))


@query
def members_list_joined(spark, d):
    """The same without a round: averages from the points themselves."""
    a = assign(points_c(spark, d), prepare_centers(K5))
    return members(a, keep=("c_custkey",))


# ---------------------------------------------------------------- convergence / order

def _step_c(spark, d, centers=K5, mode="combined"):
    return step(points_c(spark, d), centers, mode)


@query
def movement(spark, d):
    return with_movement(_step_c(spark, d)).select("rank", "new_x", "new_y", "old_x", "old_y", "move", "stable")


@query(name="any_stable")
def any_stable_query(spark, d):
    return any_stable(_step_c(spark, d, K5F))


@query(name="all_stable")
def all_stable_query(spark, d):
    return all_stable(_step_c(spark, d))


@query(name="status_message")
def status_message_query(spark, d):
    return status_message(_step_c(spark, d))


@query
def result_ordered(spark, d):
    return rank_by_center_text(_step_c(spark, d)).select("pos", "new_x", "new_y", "old_x", "old_y")


# ---------------------------------------------------------------- iteration policies I2–I8

@query
def fit_fixed_plain_3(spark, d):
    return fit(points_l(spark, d), K5, iterations=3, mode="plain").result().select(*RESULT_COLS)


@query
def fit_fixed_combined_3(spark, d):
    return fit(points_c(spark, d), K5, iterations=3, mode="combined").result().select(*RESULT_COLS)


def _fit_stop(spark, d, centers, rule):
    return fit(points_c(spark, d), centers, iterations=5, mode="plain", stop=rule).result().select(*RESULT_COLS)


@query
def fit_stop_any_k5(spark, d):
    return _fit_stop(spark, d, K5, "any")


@query
def fit_stop_any_k5f(spark, d):
    return _fit_stop(spark, d, K5F, "any")


@query
def fit_stop_all_k5(spark, d):
    return _fit_stop(spark, d, K5, "all")


@query
def fit_stop_all_k5f(spark, d):
    return _fit_stop(spark, d, K5F, "all")


@query
def fit_fixed_plain_sentinel_3(spark, d):
    return fit(points_e(spark, d), KE, iterations=3, mode="plain").result().select(*RESULT_COLS)


@query
def fit_fixed_combined_sentinel_3(spark, d):
    return fit(points_e(spark, d), KE, iterations=3, mode="combined").result().select(*RESULT_COLS)


@query
def fit_fixed_combined_sentinel_10(spark, d):
    """Ten combined rounds on event points (a long chain)."""
    return fit(points_e(spark, d), KE, iterations=10, mode="combined").result().select(*RESULT_COLS)


@query
def fit_collapsed_sentinel_3(spark, d):
    """Three plain rounds over event points merged into weights first."""
    res = fit(points_e(spark, d), KE, iterations=3, mode="plain", collapse=True)
    return res.result().select(*RESULT_COLS)


@query
def fit_large_k_3(spark, d):
    """Three rounds with 60 centres: the vectorised search inside the loop."""
    return fit(points_c(spark, d), LATTICE_60, iterations=3, mode="combined").result().select(*RESULT_COLS)


@query
def fit_stop_all_lineitem(spark, d):
    return fit(points_l(spark, d), K5, iterations=5, mode="plain", stop="all").result().select(*RESULT_COLS)


@query
def fit_stop_any_lineitem(spark, d):
    return fit(points_l(spark, d), K5, iterations=5, mode="plain", stop="any").result().select(*RESULT_COLS)


@query
def fit_persist_table_3(spark, d):
    """Points materialised once as a table under the checkpoint folder, then three rounds."""
    res = fit(points_l(spark, d), K5, iterations=3, mode="combined", persist="table")
    return res.result().select(*RESULT_COLS)


@query
def dup_centers_plain(spark, d):
    return step(points_c(spark, d), KDUP, "plain").select(*STEP_COLS)


@query
def fit_status_3(spark, d):
    return fit(points_c(spark, d), K5, iterations=3, mode="combined").status_rows()


@query
def fit_final_assignment_2(spark, d):
    pts = points_l(spark, d)
    res = fit(pts, K5, iterations=2, mode="combined")
    return res.assignment(pts).select("l_orderkey", "l_linenumber", "x", "y", "center_x", "center_y")


@query
def run_history(spark, d):
    res = fit(points_c(spark, d), K5, iterations=3, mode="plain")
    return res.history().drop("seconds")


@query
def fit_resumed_history(spark, d):
    """Two rounds, then a resumed run of five: the history of an uninterrupted one."""
    prefix = scratch_path(spark, "resumed") + "/it"
    fit(points_c(spark, d), K5, iterations=2, mode="plain", output_prefix=prefix)
    res = fit(points_c(spark, d), K5, iterations=5, mode="plain", output_prefix=prefix, resume=True)
    return res.history().drop("seconds")


@query
def listing_line_positions(spark, d):
    """The final listing's lines with their position in the written files."""
    prefix = scratch_path(spark, "positions") + "/it"
    fit(points_c(spark, d), K5, iterations=2, mode="combined", output_prefix=prefix, final_listing=True)
    return line_positions(spark, iteration_path(prefix, "Final"))


# ---------------------------------------------------------------- a table of centres

def _fit_many(spark, d, iterations, **options):
    return fit(points_c(spark, d), centers_o(spark, d), iterations=iterations, in_plan=MANY, **options)


@query
def fit_many_centers_2(spark, d):
    """Two rounds over a table of centres: their rows stay in tables."""
    return _fit_many(spark, d, 2).result().select(*RESULT_COLS)


@query
def fit_many_centers_stop_any(spark, d):
    return _fit_many(spark, d, 3, mode="plain", stop="any").result().select(*RESULT_COLS)


@query
def fit_many_centers_history(spark, d):
    return _fit_many(spark, d, 2, mode="plain").history().drop("seconds")


@query
def fit_many_centers_resumed(spark, d):
    """One round, then a resumed run of two with status files, read back."""
    prefix = scratch_path(spark, "many") + "/it"
    _fit_many(spark, d, 1, output_prefix=prefix, status_files=True)
    res = _fit_many(spark, d, 2, output_prefix=prefix, status_files=True, resume=True)
    if res.resumed_from != 1:
        raise AssertionError("the first round was not taken over")
    return read_status_centers(spark, iteration_path(prefix, 2))


@query
def fit_many_centers_listing(spark, d):
    """The listing of a run over a table of centres, with its lines' positions in the written files."""
    prefix = scratch_path(spark, "many-listing") + "/it"
    _fit_many(spark, d, 1, output_prefix=prefix, final_listing=True)
    return line_positions(spark, iteration_path(prefix, "Final"))


@query
def result_file_many_centers(spark, d):
    """S6 with one line per order: the lines' positions over all parts."""
    prefix = scratch_path(spark, "many-result") + "/it"
    _fit_many(spark, d, 1, output_prefix=prefix)
    return line_positions(spark, iteration_path(prefix, 1))


@query
def centers_file_many(spark, d):
    """S2 with one line per order: written in several parts, read in splits."""
    path = scratch_path(spark, "many-centres")
    (centers_o(spark, d).orderBy("rank").select(F.concat_ws(",", _s("x"), _s("y")).alias("value")).write.text(path))
    return read_centers(spark, path)


@query
def centers_json_file(spark, d):
    """S10 as a file of one centre a line, written and read by ranges."""
    path = scratch_path(spark, "json")
    write_centers_json(centers_o(spark, d), path)
    return read_centers_json(spark, path)


@query
def stream_assign_many_centers(spark, d):
    """J3 on a stream of customer rows against a saved index of one centre per order."""
    pts = _stream_points(spark, d, "customer", lambda s: points_from(
        s, F.floor(F.col("c_acctbal")), (F.col("c_custkey") * 37) % 10000, keep=("c_custkey",)))
    index, out = scratch_path(spark, "index"), scratch_path(spark, "stream-many")
    build_index(ranked_table(centers_o(spark, d))).save(index)
    assign_stream_table(pts, index, out).awaitTermination()
    return spark.read.parquet(out).select("c_custkey", "x", "y", "center_rank", "center_x", "center_y")


# ---------------------------------------------------------------- sinks S6–S9

@query
def sink_roundtrip_result(spark, d):
    prefix = scratch_path(spark, "result") + "/it"
    fit(points_c(spark, d), K5, iterations=2, mode="combined", output_prefix=prefix)
    return read_result(spark, iteration_path(prefix, 2))


@query
def sink_roundtrip_status(spark, d):
    prefix = scratch_path(spark, "status") + "/it"
    fit(points_c(spark, d), K5, iterations=2, mode="combined", output_prefix=prefix, status_files=True)
    return read_status_centers(spark, iteration_path(prefix, 2))


@query
def sink_roundtrip_assignment(spark, d):
    prefix = scratch_path(spark, "listing") + "/it"
    fit(points_c(spark, d), K5, iterations=2, mode="combined", output_prefix=prefix, final_listing=True)
    return read_assignments(spark, iteration_path(prefix, "Final"))


@query
def result_text_lines(spark, d):
    """S6 rendering: ``newX,newY<TAB>oldX,oldY`` per centre."""
    return result_lines(step(points_l(spark, d), K5, "plain")).select("key", "value")


@query
def status_text_lines(spark, d):
    """S7 rendering: the status line, then one ``x,y`` line per new centre."""
    res = fit(points_c(spark, d), K5, iterations=2, mode="combined")
    last = res.iterations[-1]
    return status_lines(res.result(), last.status).select("part", "key", "value")


@query
def assignment_text_lines(spark, d):
    """S8 rendering: ``cx,cy<TAB>x,y `` per point."""
    a = assign(points_l(spark, d), prepare_centers(K5))
    return assignment_lines(a).select("key", "x", "y", "value")


@query
def points_collapsed(spark, d):
    """Equal event points merged into weights (the exact pre-collapse)."""
    return collapse_points(points_e(spark, d).select("x", "y")).select("x", "y", "weight")


@query
def sink_roundtrip_parquet(spark, d):
    """S6/S8 in parquet: a round's result and the final listing, written and read back."""
    pts = points_c(spark, d)
    res = fit(pts, K5, iterations=1, mode="combined")
    base = scratch_path(spark, "parquet-sinks")
    write_result(res.result(), f"{base}/result", fmt="parquet")
    write_assignments(res.assignment(pts), f"{base}/listing", fmt="parquet")
    result = spark.read.parquet(f"{base}/result").select(
        F.lit("result").alias("kind"), F.col("new_x").alias("a"), F.col("new_y").alias("b"),
        F.col("old_x").alias("c"), F.col("old_y").alias("d"))
    listing = spark.read.parquet(f"{base}/listing").select(
        F.lit("listing").alias("kind"), F.col("center_x").alias("a"), F.col("center_y").alias("b"),
        F.col("x").alias("c"), F.col("y").alias("d"))
    return result.unionByName(listing)


# ---------------------------------------------------------------- streaming

def _stream_points(spark, d, name, project):
    schema = table(spark, d, name).schema
    stream = read_table_stream(spark, f"{d.rstrip('/')}/{name}.parquet*", schema, base_path=d)
    return project(stream)


@query
def stream_assign(spark, d):
    """J3 on a stream of customer rows, appended to files and read back."""
    pts = _stream_points(spark, d, "customer", lambda s: points_from(
        s, F.floor(F.col("c_acctbal")), (F.col("c_custkey") * 37) % 10000, keep=("c_custkey",)))
    out = scratch_path(spark, "stream-assign")
    write_stream(assign_stream(pts, K5), out).awaitTermination()
    return spark.read.parquet(out).select("c_custkey", "x", "y", "center_rank", "center_x", "center_y")


@query
def stream_running_step(spark, d):
    """A plain-mode step kept current over a stream of event rows."""
    pts = _stream_points(spark, d, "events", lambda s: points_from(
        s, (F.col("user_id") % 9) - 4, F.floor(F.col("value"))))
    out = scratch_path(spark, "stream-step")
    running_step(pts, KE, out, mode="plain").awaitTermination()
    return spark.read.parquet(out).select(F.lit(1).alias("iteration"), "rank", "new_x", "new_y", "old_x", "old_y",
                                          "n_points")


def queries() -> dict[str, Query]:
    return dict(QUERIES)

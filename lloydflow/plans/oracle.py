"""Independent SQL (DuckDB dialect) for every catalog query — the correctness oracle.

The oracle is written the naive way on purpose: the arg-min pairs every point
with every centre and keeps ``row_number() = 1`` by (distance, rank), and
R iterations are R chained CTEs.  It shares no code with the Spark plans.
"""

from __future__ import annotations

from collections.abc import Sequence

from .workload import (
    CENTERS_O_SQL,
    CENTERS_S_SQL,
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
    POINTS_C_SQL,
    POINTS_E_SQL,
    POINTS_L_SQL,
    POINTS_S_SQL,
    THRESHOLD,
)

STATUS_SQL = "CASE WHEN bool_and({stable}) THEN 'Has converged' ELSE 'Has not converged' END"
STATUS_WINDOW_SQL = "CASE WHEN bool_and({stable}) OVER () THEN 'Has converged' ELSE 'Has not converged' END"


def _text(x: str, y: str) -> str:
    return f"(CAST({x} AS VARCHAR) || ',' || CAST({y} AS VARCHAR))"


def _values(pairs: Sequence[tuple[int, int]]) -> str:
    rows = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(pairs))
    return f"(VALUES {rows}) AS t(rank, x, y)"


def _move(a: str = "") -> str:
    p = f"{a}." if a else ""
    return (f"greatest(abs(CAST({p}new_x AS BIGINT) - {p}old_x), abs(CAST({p}new_y AS BIGINT) - {p}old_y))")


class Chain:
    """CTE builder: numbered points ``pp``, centres ``c1``, and per iteration r
    the assignment ``a{r}``, statistics ``s{r}``, result ``r{r}`` (with output
    position ``pos``) and next centres ``c{r+1}``."""

    def __init__(self, points_sql: str, centers: Sequence[tuple[int, int]] | str, mode: str = "combined"):
        self.mode = mode
        source = f"({centers})" if isinstance(centers, str) else _values(centers)
        self.ctes = [
            f"pp AS (SELECT row_number() OVER () AS pid, q.* FROM ({points_sql}) q)",
            f"c1 AS (SELECT CAST(min(rank) AS INTEGER) AS rank, x, y FROM {source} GROUP BY x, y)",
        ]
        self.done = 0

    def assign(self, name: str, centers_cte: str) -> str:
        dist = ("sqrt((CAST(p.x AS DOUBLE) - c.x) * (CAST(p.x AS DOUBLE) - c.x) + "
                "(CAST(p.y AS DOUBLE) - c.y) * (CAST(p.y AS DOUBLE) - c.y))")
        self.ctes.append(
            f"{name} AS (SELECT p.*, c.rank AS crank, c.x AS cx, c.y AS cy FROM pp p CROSS JOIN {centers_cte} c "
            f"QUALIFY row_number() OVER (PARTITION BY p.pid ORDER BY {dist}, c.rank) = 1)"
        )
        return name

    def iterate(self, times: int = 1) -> Chain:
        for _ in range(times):
            r = self.done + 1
            self.assign(f"a{r}", f"c{r}")
            flt = " FILTER (WHERE x <> -1)" if self.mode == "plain" else ""
            self.ctes.append(
                f"s{r} AS (SELECT crank AS rank, CAST(sum(x){flt} AS BIGINT) AS sx, CAST(sum(y){flt} AS BIGINT) AS sy, "
                f"count(*){flt} AS n, count(*) AS np FROM a{r} GROUP BY crank)"
            )
            keep = "coalesce(s.sx, 0) = 0" if self.mode == "plain" else "coalesce(s.n, 0) = 0"
            self.ctes.append(
                f"r{r} AS (SELECT CAST({r} AS INTEGER) AS iteration, c.rank, c.x AS old_x, c.y AS old_y, "
                f"CASE WHEN {keep} THEN c.x ELSE CAST(s.sx // s.n AS INTEGER) END AS new_x, "
                f"CASE WHEN {keep} THEN c.y ELSE CAST(s.sy // s.n AS INTEGER) END AS new_y, "
                f"CAST(coalesce(s.np, 0) AS BIGINT) AS n_points, "
                f"CAST(row_number() OVER (ORDER BY {_text('c.x', 'c.y')}) - 1 AS INTEGER) AS pos "
                f"FROM c{r} c LEFT JOIN s{r} s ON c.rank = s.rank)"
            )
            self.ctes.append(
                f"c{r + 1} AS (SELECT CAST(min(pos) AS INTEGER) AS rank, new_x AS x, new_y AS y FROM r{r} "
                f"GROUP BY new_x, new_y)"
            )
            self.done = r
        return self

    def sql(self, select: str) -> str:
        return "WITH " + ",\n".join(self.ctes) + "\n" + select


RESULT_COLS = "iteration, pos, new_x, new_y, old_x, old_y, n_points"
STEP_COLS = "iteration, rank, new_x, new_y, old_x, old_y, n_points"


def step_sql(points: str, centers, mode: str) -> str:
    return Chain(points, centers, mode).iterate().sql(f"SELECT {STEP_COLS} FROM r1")


def fit_sql(points: str, centers, mode: str, r: int) -> str:
    return Chain(points, centers, mode).iterate(r).sql(f"SELECT {RESULT_COLS} FROM r{r}")


def fit_stop_sql(points: str, centers, mode: str, stop: str, limit: int = 5) -> str:
    ch = Chain(points, centers, mode).iterate(limit)
    union = " UNION ALL ".join(f"SELECT * FROM r{r}" for r in range(1, limit + 1))
    ch.ctes.append(f"allr AS ({union})")
    ch.ctes.append(
        f"per_it AS (SELECT iteration, bool_or({_move()} < {THRESHOLD}) AS any_st, "
        f"bool_and({_move()} < {THRESHOLD}) AS all_st FROM allr GROUP BY iteration)"
    )
    cond = "any_st AND iteration >= 2" if stop == "any" else "all_st"
    ch.ctes.append(f"stop_it AS (SELECT coalesce(min(iteration) FILTER (WHERE {cond}), {limit}) AS it FROM per_it)")
    return ch.sql(f"SELECT {RESULT_COLS} FROM allr WHERE iteration = (SELECT it FROM stop_it)")


LISTING_LINES_SQL = (
    f"SELECT CAST(row_number() OVER (ORDER BY {_text('cx', 'cy')}, x, y) - 1 AS BIGINT) AS pos, "
    f"{_text('cx', 'cy')} || chr(9) || {_text('x', 'y')} || ' ' AS line FROM fa")


def history_sql(points: str, centers, mode: str, r: int) -> str:
    return Chain(points, centers, mode).iterate(r).sql(
        " UNION ALL ".join(
            f"SELECT iteration, CAST(count(*) AS INTEGER) AS k, CAST(sum(n_points) AS BIGINT) AS n_points, "
            f"max({_move()}) AS max_move, CAST(count(*) FILTER (WHERE {_move()} < {THRESHOLD}) AS INTEGER) AS n_stable, "
            f"{STATUS_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS status FROM r{i} GROUP BY iteration"
            for i in range(1, r + 1)
        )
    )


def assign_sql(points: str, centers, keys: str) -> str:
    ch = Chain(points, centers)
    ch.assign("a", "c1")
    return ch.sql(f"SELECT {keys}, x, y, crank AS center_rank, cx AS center_x, cy AS center_y FROM a")


def oracle_sql() -> dict[str, str]:
    L, C, E, S = POINTS_L_SQL, POINTS_C_SQL, POINTS_E_SQL, POINTS_S_SQL
    q: dict[str, str] = {}

    # --- sources (S1–S5) ---------------------------------------------------
    q["points_projection"] = f"SELECT c_custkey, x, y FROM ({C})"
    q["points_parse_text"] = f"SELECT c_custkey, x, y FROM ({C})"
    q["points_file_roundtrip"] = f"SELECT x, y FROM ({C})"
    q["centers_parse_text"] = f"SELECT CAST(c_custkey AS INTEGER) AS rank, x, y FROM ({C})"
    q["centers_file_roundtrip"] = Chain(L, K5).iterate().sql("SELECT pos AS rank, new_x AS x, new_y AS y FROM r1")
    q["status_centers_parse"] = (
        f"SELECT l.l_orderkey AS doc, CASE WHEN o.o_orderstatus = 'F' THEN 'Has converged' "
        f"ELSE 'Has not converged' END AS status, CAST(l.l_linenumber - 1 AS INTEGER) AS rank, l.x, l.y "
        f"FROM ({L}) l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"
    )
    q["result_parse_pairs"] = (
        f"SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS rank, x AS new_x, y AS new_y, "
        f"CAST(x + l_linenumber * 7 - 20 AS INTEGER) AS old_x, CAST(y - l_suppkey % 50 AS INTEGER) AS old_y "
        f"FROM ({L})"
    )

    # --- JSON exchange (S10) -------------------------------------------------
    json_agg = (
        "'[' || string_agg('{\"x\":' || CAST(new_x AS VARCHAR) || ',\"y\":' || CAST(new_y AS VARCHAR) || '}', ',' "
        "ORDER BY pos) || ']'"
    )
    q["centers_json_export"] = Chain(L, K5).iterate().sql(f"SELECT {json_agg} AS centers_json FROM r1")
    q["centers_json_import"] = Chain(L, K5).iterate().sql("SELECT pos AS rank, new_x AS x, new_y AS y FROM r1")

    # --- scalar functions (F1–F3) -------------------------------------------
    dists = ", ".join(
        f"sqrt((CAST(x AS DOUBLE) - {cx}) * (CAST(x AS DOUBLE) - {cx}) + "
        f"(CAST(y AS DOUBLE) - {cy}) * (CAST(y AS DOUBLE) - {cy})) AS dist_{i}"
        for i, (cx, cy) in enumerate(K5)
    )
    q["distance_matrix"] = f"SELECT c_custkey, x, y, {dists} FROM ({C})"
    ch = Chain(C, K5)
    ch.assign("a", "c1")
    q["center_and_point_text"] = ch.sql(
        f"SELECT c_custkey, '(' || CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ')' AS point_text, "
        f"{_text('cx', 'cy')} AS center_text FROM a"
    )

    # --- assignment (J1, J3) --------------------------------------------------
    q["assign_nearest"] = assign_sql(L, K5, "l_orderkey, l_linenumber")
    q["assign_vectorized"] = assign_sql(L, K5, "l_orderkey, l_linenumber")
    q["assign_tie_first"] = assign_sql(E, KT, "event_id")
    q["assign_large_k"] = assign_sql(C, LATTICE_60, "c_custkey")

    # --- one step (I1, A1, J2, F5–F9, A9) ---------------------------------------
    q["step_plain"] = step_sql(L, K5, "plain")
    q["step_combined"] = step_sql(L, K5, "combined")
    q["step_plain_sentinel"] = step_sql(E, KE, "plain")
    q["step_combined_sentinel"] = step_sql(E, KE, "combined")
    q["step_collapsed_sentinel"] = step_sql(E, KE, "plain")
    q["step_large_k"] = step_sql(C, LATTICE_60, "combined")
    q["step_grid_k200"] = step_sql(L, LATTICE_200, "combined")
    q["preserve_empty"] = step_sql(C, K5F, "combined")
    q["dup_centers_collapse"] = step_sql(C, KDUP, "combined")

    q["assign_root_ties"] = assign_sql(S, KROOT, "c_custkey")
    q["assign_root_ties_vectorized"] = assign_sql(S, KROOT_44, "c_custkey")
    q["step_far_center"] = step_sql(C, LATTICE_1000F, "combined")
    q["step_many_centers"] = step_sql(C, CENTERS_O_SQL, "combined")
    q["step_many_centers_plain"] = step_sql(L, CENTERS_S_SQL, "plain")
    q["assign_many_centers"] = assign_sql(C, CENTERS_O_SQL, "c_custkey")
    q["stream_assign_many_centers"] = q["assign_many_centers"]
    q["fit_many_centers_2"] = fit_sql(C, CENTERS_O_SQL, "combined", 2)
    q["fit_many_centers_stop_any"] = fit_stop_sql(C, CENTERS_O_SQL, "plain", "any", 3)
    q["fit_many_centers_history"] = history_sql(C, CENTERS_O_SQL, "plain", 2)
    q["fit_many_centers_resumed"] = Chain(C, CENTERS_O_SQL).iterate(2).sql(
        f"SELECT {STATUS_WINDOW_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS status, pos AS rank, new_x AS x, new_y AS y FROM r2")
    q["result_file_many_centers"] = Chain(C, CENTERS_O_SQL).iterate(1).sql(
        f"SELECT CAST(pos AS BIGINT) AS pos, {_text('new_x', 'new_y')} || chr(9) || {_text('old_x', 'old_y')} AS line FROM r1")
    ch = Chain(C, CENTERS_O_SQL).iterate(1)
    ch.assign("fa", "c2")
    q["fit_many_centers_listing"] = ch.sql(LISTING_LINES_SQL)
    q["centers_file_many"] = f"SELECT CAST(rank AS INTEGER) AS rank, x, y FROM ({CENTERS_O_SQL})"
    q["centers_json_file"] = q["centers_file_many"]
    ch = Chain(C, K5)
    ch.assign("a", "c1")
    q["distance_to_center"] = ch.sql(
        "SELECT c_custkey, sqrt(pow(CAST(x AS DOUBLE) - cx, 2) + pow(CAST(y AS DOUBLE) - cy, 2)) AS dist FROM a")

    # --- partial aggregation (A2–A4, O3) --------------------------------------
    q["merge_partials_plain_sentinel"] = step_sql(E, KE, "plain")
    ch = Chain(L, K5)
    ch.assign("a", "c1")
    q["partials_evaluation"] = ch.sql(
        "SELECT crank AS center_rank, count(*) AS n, false AS only_seed, "
        "CAST(CAST(sum(x) AS BIGINT) // count(*) AS INTEGER) AS avg_x, "
        "CAST(CAST(sum(y) AS BIGINT) // count(*) AS INTEGER) AS avg_y, crank % 2 = 0 AS same FROM a GROUP BY crank "
        "UNION ALL SELECT CAST(rank + 100 AS INTEGER), 0, true, NULL, NULL, rank % 2 = 0 FROM c1")
    ch = Chain(L, K5)
    ch.assign("a", "c1")
    q["partials"] = ch.sql(
        "SELECT CAST(l_orderkey % 8 AS INTEGER) AS split, crank AS center_rank, CAST(sum(x) AS BIGINT) AS sum_x, "
        "CAST(sum(y) AS BIGINT) AS sum_y, count(*) AS n, false AS only_seed FROM a GROUP BY ALL"
    )
    q["merge_partials"] = step_sql(L, K5, "combined")

    # --- member list (A5) -----------------------------------------------------
    ch = Chain(C, K5)
    ch.assign("a", "c1")
    ch.ctes.append(
        "m AS (SELECT crank, CAST(CAST(sum(x) AS BIGINT) // count(*) AS INTEGER) AS avg_x, "
        "CAST(CAST(sum(y) AS BIGINT) // count(*) AS INTEGER) AS avg_y, count(*) AS n_members FROM a GROUP BY crank)"
    )
    q["members_list"] = ch.sql(
        "SELECT c_custkey, cx AS center_x, cy AS center_y, avg_x, avg_y, n_members, x, y, "
        "'(' || CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ')' AS member FROM a JOIN m USING (crank)"
    )
    q["members_list_joined"] = q["members_list"]

    # --- convergence (F8, A6–A8) and ordering (O1, O2) ---------------------------
    q["movement"] = Chain(C, K5).iterate().sql(
        f"SELECT rank, new_x, new_y, old_x, old_y, {_move()} AS move, {_move()} < {THRESHOLD} AS stable FROM r1"
    )
    q["any_stable"] = Chain(C, K5F).iterate().sql(f"SELECT bool_or({_move()} < {THRESHOLD}) AS any_stable FROM r1")
    q["all_stable"] = Chain(C, K5).iterate().sql(f"SELECT bool_and({_move()} < {THRESHOLD}) AS all_stable FROM r1")
    q["status_message"] = Chain(C, K5).iterate().sql(
        f"SELECT {STATUS_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS status FROM r1"
    )
    q["result_ordered"] = Chain(C, K5).iterate().sql("SELECT pos, new_x, new_y, old_x, old_y FROM r1")

    # --- iteration policies (I2–I8) -------------------------------------------
    q["fit_fixed_plain_3"] = fit_sql(L, K5, "plain", 3)
    q["fit_fixed_combined_3"] = fit_sql(C, K5, "combined", 3)
    q["fit_stop_any_k5"] = fit_stop_sql(C, K5, "plain", "any")
    q["fit_stop_any_k5f"] = fit_stop_sql(C, K5F, "plain", "any")
    q["fit_stop_all_k5"] = fit_stop_sql(C, K5, "plain", "all")
    q["fit_stop_all_k5f"] = fit_stop_sql(C, K5F, "plain", "all")
    q["fit_fixed_plain_sentinel_3"] = fit_sql(E, KE, "plain", 3)
    q["fit_fixed_combined_sentinel_3"] = fit_sql(E, KE, "combined", 3)
    q["fit_fixed_combined_sentinel_10"] = fit_sql(E, KE, "combined", 10)
    q["fit_collapsed_sentinel_3"] = fit_sql(E, KE, "plain", 3)
    q["fit_large_k_3"] = fit_sql(C, LATTICE_60, "combined", 3)
    q["fit_stop_all_lineitem"] = fit_stop_sql(L, K5, "plain", "all")
    q["fit_stop_any_lineitem"] = fit_stop_sql(L, K5, "plain", "any")
    q["fit_persist_table_3"] = fit_sql(L, K5, "combined", 3)
    q["dup_centers_plain"] = step_sql(C, KDUP, "plain")
    ch = Chain(C, K5).iterate(3)
    parts = " UNION ALL ".join(
        f"SELECT iteration, {STATUS_WINDOW_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS status, "
        f"pos AS rank, new_x AS x, new_y AS y FROM r{r}"
        for r in range(1, 4)
    )
    q["fit_status_3"] = ch.sql(parts)
    ch = Chain(L, K5).iterate(2)
    ch.assign("fa", "c3")
    q["fit_final_assignment_2"] = ch.sql("SELECT l_orderkey, l_linenumber, x, y, cx AS center_x, cy AS center_y FROM fa")
    q["run_history"] = history_sql(C, K5, "plain", 3)
    q["fit_resumed_history"] = history_sql(C, K5, "plain", 5)
    ch = Chain(C, K5).iterate(2)
    ch.assign("fa", "c3")
    q["listing_line_positions"] = ch.sql(LISTING_LINES_SQL)

    # --- sinks read back (S6–S9) ------------------------------------------------
    q["sink_roundtrip_result"] = Chain(C, K5).iterate(2).sql(
        "SELECT pos AS rank, new_x, new_y, old_x, old_y FROM r2"
    )
    q["sink_roundtrip_status"] = Chain(C, K5).iterate(2).sql(
        f"SELECT {STATUS_WINDOW_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS status, pos AS rank, "
        f"new_x AS x, new_y AS y FROM r2"
    )
    ch = Chain(C, K5).iterate(2)
    ch.assign("fa", "c3")
    q["sink_roundtrip_assignment"] = ch.sql("SELECT cx AS center_x, cy AS center_y, x, y FROM fa")
    q["result_text_lines"] = Chain(L, K5, "plain").iterate().sql(
        f"SELECT {_text('old_x', 'old_y')} AS key, {_text('new_x', 'new_y')} || chr(9) || {_text('old_x', 'old_y')} "
        f"AS value FROM r1"
    )
    q["status_text_lines"] = Chain(C, K5).iterate(2).sql(
        f"SELECT 0 AS part, '' AS key, {STATUS_SQL.format(stable=f'{_move()} < {THRESHOLD}')} AS value FROM r2 "
        f"UNION ALL SELECT 1 AS part, {_text('old_x', 'old_y')} AS key, {_text('new_x', 'new_y')} AS value FROM r2"
    )
    ch = Chain(L, K5)
    ch.assign("a", "c1")
    q["assignment_text_lines"] = ch.sql(
        f"SELECT {_text('cx', 'cy')} AS key, x, y, {_text('cx', 'cy')} || chr(9) || {_text('x', 'y')} || ' ' AS value "
        f"FROM a"
    )
    q["points_collapsed"] = f"SELECT x, y, count(*) AS weight FROM ({E}) GROUP BY x, y"
    ch = Chain(C, K5).iterate(1)
    ch.assign("fa", "c2")
    q["sink_roundtrip_parquet"] = ch.sql(
        "SELECT 'result' AS kind, new_x AS a, new_y AS b, old_x AS c, old_y AS d FROM r1 "
        "UNION ALL SELECT 'listing' AS kind, cx AS a, cy AS b, x AS c, y AS d FROM fa"
    )

    # --- streaming: the same operators, run to completion over a file stream ------
    q["stream_assign"] = assign_sql(C, K5, "c_custkey")
    q["stream_running_step"] = step_sql(E, KE, "plain")
    return q

"""Centre sources and exchange formats.

A centre list decides ties by its order, so the positions of a file's lines become
ranks.  A file of any length is read in splits by several tasks: its lines are written with
their split and place, and the counts of the splits before (one row a split) are
added.  The line-level parsers take ``(position, line)`` rows so the same logic also
applies to lines Spark derives from tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import IN_PLAN_CENTERS, STATUS_CONVERGED, STATUS_NOT_CONVERGED
from ..functions.parse import field, fields, strict_int
from ..operators.ordering import number_rows
from ..session import local_frame, written

CENTER_SCHEMA = "rank INT, x INT, y INT"
CENTER_JSON_TYPE = "array<struct<x:int,y:int>>"


# ---------------------------------------------------------------- line parsers

def parse_center_lines(lines: DataFrame, pos_col: str = "pos", line_col: str = "line",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """S2 body: ``x,y`` or ``x<TAB>y`` lines → ``rank, x, y`` (rank = line position)."""
    parts = fields(F.col(line_col))
    return lines.select(
        *keep,
        F.col(pos_col).cast("int").alias("rank"),
        strict_int(field(parts, 0), "centre x").alias("x"),
        strict_int(field(parts, 1), "centre y").alias("y"),
    )


def parse_result_lines(lines: DataFrame, pos_col: str = "pos", line_col: str = "line",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """``newX,newY<TAB>oldX,oldY`` lines → ``rank, new_x, new_y, old_x, old_y``."""
    parts = fields(F.col(line_col))
    names = ("new_x", "new_y", "old_x", "old_y")
    return lines.select(
        *keep,
        F.col(pos_col).cast("int").alias("rank"),
        *[strict_int(field(parts, i), f"result {n}").alias(n) for i, n in enumerate(names)],
    )


def parse_status_lines(lines: DataFrame, doc_col: str = "doc", pos_col: str = "pos",
                       line_col: str = "line") -> DataFrame:
    """S4 on line rows: per document, line 0 is the status, the rest are centres.

    The status is attached to its document's centre rows with an equi-join on
    the document key (one status row per document on the build side).
    """
    status = lines.filter(F.col(pos_col) == 0).select(F.col(doc_col), F.col(line_col).alias("status"))
    body = lines.filter(F.col(pos_col) > 0).withColumn(pos_col, F.col(pos_col) - 1)
    centers = parse_center_lines(body, pos_col, line_col, keep=(doc_col,))
    return centers.join(status, doc_col, "left").select(doc_col, "status", "rank", "x", "y")


# ---------------------------------------------------------------- file readers

def _numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple[str, int, str]]]:
    """The lines of a file, directory or glob as ``file, line_no, pos, line``; and each file's first line.

    ``pos`` goes on from file to file in the order of their names; lines that are empty
    up to the end of their file are left out.  The second result has ``(file, lines,
    first line)`` per file that has lines.
    """
    lines = written(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")), "lines")
    filled = F.when(F.col("line") != "", F.col("at"))
    # One row per split of the input: its lines are contiguous in one task.
    splits = lines.groupBy("file", "block").agg(F.min("at"), F.count(F.lit(1)), F.max(filled)).orderBy("file", "block").collect()
    kept: dict[str, int] = {}  # lines of a file up to its last filled one
    starts: dict[str, int] = {}
    places = []
    for file, block, at, n, last in splits:
        shift = starts.get(file, 0)
        starts[file] = shift + n
        if last is not None:
            kept[file] = shift + last - at + 1
        places.append((file, block, shift - at))
    first, total = {}, 0
    for file in sorted(kept):
        first[file] = total
        total += kept[file]
    plan = local_frame(spark, [(f, b, s, kept[f], first[f]) for f, b, s in places if f in kept],
                       "file STRING, block BIGINT, shift BIGINT, kept BIGINT, first BIGINT")
    numbered = (lines.join(F.broadcast(plan), ["file", "block"]).withColumn("line_no", F.col("at") + F.col("shift"))
                .filter("line_no < kept").select("file", "line_no", (F.col("first") + F.col("line_no")).alias("pos"), "line"))
    heads = {r["file"]: r["line"] for r in numbered.filter("line_no = 0").select("file", "line").collect()}
    return numbered, [(f, kept[f], heads[f]) for f in sorted(kept)]


def line_positions(spark: SparkSession, path: str) -> DataFrame:
    """``pos, line``: the lines of an output with their position over all its parts."""
    return _numbered_lines(spark, path)[0].select("pos", "line")


def read_centers(spark: SparkSession, path: str) -> DataFrame:
    """A seed centre file → ``rank, x, y`` in line order."""
    return parse_center_lines(_numbered_lines(spark, path)[0])


def read_status_centers(spark: SparkSession, path: str) -> DataFrame:
    """A status-headed centre file → ``status, rank, x, y`` (line 1 is the status).

    Of several files (the parts of one output, or a glob of outputs) the first has a status
    line; a later one begins a new output if its first line is one of the two
    status texts, and otherwise goes on with the one before it.
    """
    lines, files = _numbered_lines(spark, path)
    headed, status, skipped = [], None, 0
    for i, (file, _, head) in enumerate(files):
        own = i == 0 or head in (STATUS_CONVERGED, STATUS_NOT_CONVERGED)
        status = head if own else status
        skipped += own
        headed.append((file, status, int(own), skipped))
    by_file = local_frame(spark, headed, "file STRING, status STRING, own INT, skipped BIGINT")
    body = lines.join(F.broadcast(by_file), "file").filter("line_no >= own").withColumn("pos", F.col("pos") - F.col("skipped"))
    return parse_center_lines(body, keep=("status",))


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """An iteration result file → ``rank, new_x, new_y, old_x, old_y`` in line order."""
    return parse_result_lines(_numbered_lines(spark, path)[0])


def next_centers(result: DataFrame) -> DataFrame:
    """S3 as a table operation: the new centres of a result, ranked by line order."""
    return result.select("rank", F.col("new_x").alias("x"), F.col("new_y").alias("y"))


# ---------------------------------------------------------------- JSON exchange

def centers_to_json(centers: DataFrame, group_cols: Sequence[str] = (), rank: str = "rank",
                    x: str = "x", y: str = "y") -> DataFrame:
    """S10 export: ``[{"x":..,"y":..},…]`` in rank order, one string per group.

    The format is one text per list, so a group is one list of centres by
    definition; only its ranks and coordinates travel.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(x).alias("x"), F.col(y).alias("y"))))
    as_xy = F.transform(ordered, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))
    return centers.groupBy(*group_cols).agg(F.to_json(as_xy).alias("centers_json"))


def write_centers_json(centers: DataFrame, path: str, rank: str = "rank", x: str = "x", y: str = "y", mode: str = "errorifexists") -> None:
    """S10 export of a list of any length: the array as text, one centre a line.

    The lines of the parts, in the order of their names, are one JSON array in rank order; each
    task writes its own range of ranks.
    """
    numbered = number_rows(centers.select(F.col(rank).alias("rank"), F.col(x).alias("x"), F.col(y).alias("y")), ["rank"], "pos")
    n = numbered.count()
    if not n:
        numbered.sparkSession.range(1).select(F.lit("[]")).coalesce(1).write.mode(mode).text(path)
        return
    mark = F.when(F.col("pos") == 0, "[").otherwise(",")
    end = F.when(F.col("pos") == n - 1, "]").otherwise("")
    body = F.concat(F.lit('{"x":'), F.col("x").cast("string"), F.lit(',"y":'), F.col("y").cast("string"), F.lit("}"))
    numbered.orderBy("pos").select(F.concat(mark, body, end).alias("value")).write.mode(mode).text(path)


def read_centers_json(spark: SparkSession, path: str) -> DataFrame:
    """S10 import of such files (or of an array on one line) → ``rank, x, y``."""
    lines = _numbered_lines(spark, path)[0]
    piece = F.concat(F.lit("["), F.btrim(F.col("line"), F.lit("[], ")), F.lit("]"))
    found = lines.select("pos", F.posexplode(F.from_json(piece, CENTER_JSON_TYPE, {"mode": "FAILFAST"})).alias("i", "c"))
    return number_rows(found.select("pos", "i", "c.x", "c.y"), ["pos", "i"], "rank").select(
        F.col("rank").cast("int").alias("rank"), "x", "y")


def centers_from_json(df: DataFrame, json_col: str = "centers_json", keep: tuple[str, ...] = ()) -> DataFrame:
    """S10 import: a JSON centre array → ``rank, x, y`` rows (rank = array position)."""
    parsed = F.from_json(F.col(json_col), CENTER_JSON_TYPE)
    return df.select(*keep, F.posexplode(parsed).alias("rank", "c")).select(
        *keep, F.col("rank").cast("int").alias("rank"), F.col("c.x").alias("x"), F.col("c.y").alias("y")
    )


def to_json_text(centers: Iterable[tuple[int, int]]) -> str:
    """The same JSON text built on the driver from a (bounded) centre list."""
    return "[" + ",".join(f'{{"x":{int(x)},"y":{int(y)}}}' for x, y in centers) + "]"


# ---------------------------------------------------------------- driver-side list

def collapse_centers(centers: DataFrame, rank: str = "rank", x: str = "x", y: str = "y") -> DataFrame:
    """Equal centres are one cluster; the first (lowest rank) one stays."""
    return centers.groupBy(x, y).agg(F.min(rank).alias(rank)).select(rank, x, y)


def is_table(centers, most: int = IN_PLAN_CENTERS) -> bool:
    """Whether centres are a DataFrame of more than ``most`` rows, which never comes to the driver."""
    return isinstance(centers, DataFrame) and centers.limit(most + 1).count() > most


def ranked_table(centers: DataFrame) -> DataFrame:
    """Centres of any number as a written table ``rank, x, y``: ranks 0, 1, 2, … in their order, equal ones merged."""
    _need_rank(centers)
    numbered = number_rows(centers.select("rank", "x", "y"), ["rank", "x", "y"], "pos")
    return written(collapse_centers(numbered.select(F.col("pos").cast("int").alias("rank"), "x", "y")), "centres")


def _need_rank(centers: DataFrame) -> None:
    if "rank" not in centers.columns:
        raise ValueError("a DataFrame of centres needs a rank column: their order decides ties")


def as_center_list(centers, most: int = IN_PLAN_CENTERS) -> list[tuple[int, int]]:
    """Centres in rank order as ``(x, y)`` pairs, from a sequence or a DataFrame of at most ``most`` rows.

    The list is bound into plans, so it comes to the driver whole; a longer
    DataFrame is refused here (``step``, ``fit`` and ``build_index`` take it as a table).  A DataFrame
    needs a ``rank`` column: its rows have no order of their own, and order decides ties.
    """
    if isinstance(centers, DataFrame):
        _need_rank(centers)
        rows = centers.select("rank", "x", "y").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} centres: keep them as a table")
        pairs = [(int(x), int(y)) for _, x, y in sorted(map(tuple, rows))]
    else:
        pairs = [(int(c[0]), int(c[1])) for c in centers]
    if not pairs:
        raise ValueError("no centres")
    return pairs


def ranked_distinct(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """A9 on the driver: ``(rank, x, y)`` with later duplicates dropped (first wins ties)."""
    seen: set[tuple[int, int]] = set()
    out = []
    for rank, (x, y) in enumerate(pairs):
        if (x, y) not in seen:
            seen.add((x, y))
            out.append((rank, int(x), int(y)))
    return out


def centers_frame(spark: SparkSession, ranked: Sequence[tuple[int, int, int]]) -> DataFrame:
    """A ``rank, x, y`` DataFrame of a bounded centre list (a JVM local relation)."""
    return local_frame(spark, [tuple(int(v) for v in r) for r in ranked], CENTER_SCHEMA)

"""Helpers shared by the corpus operators: reading tables, written intermediate tables, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lloydflow.session import scratch_table

#: White space of the contracts: space and U+0009 to U+000D.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, light: bool = False) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Cuts lineage so that a lost executor never forces the work above to be done
    again, and lets several readers share one evaluation.  A ``light`` table (a few
    numbers per row) is written by at most four tasks a core, so that many shuffle partitions
    don't become as many tiny files.  The tables stay until ``lloydflow.session.clear_scratch``,
    which a caller may use once the results are written.
    """
    spark = df.sparkSession
    path = scratch_table(spark, name)
    out = df.coalesce(4 * spark.sparkContext.defaultParallelism) if light else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """(_row, needed columns): every row as one struct, so that no column of the caller meets one of ours."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *[docs[c] for c in needed])


def unboxed(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns out of ``_row``, some of them replaced."""
    return df.select(*[replaced.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged.

    ``lower`` is the quick way for ASCII text; elsewhere it would also change
    letters outside A-Z, so those strings go through ``translate``.
    """
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_count(c: Column) -> Column:
    """Number of maximal runs of characters outside the white space; null counts 0."""
    t = F.btrim(c, F.lit(WS_CHARS))
    return F.when(c.isNull() | (t == ""), F.lit(0)).otherwise(F.size(F.split(t, WS_CLASS + "+"))).cast("long")


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def cell_index(df: DataFrame, keys: list[str], order: list[str], out: str, salts: int = 256) -> DataFrame:
    """Add ``out``: 0-based index of each row within its ``keys`` cell.

    A cell may hold any share of the rows, so it is never one window: rows are
    dealt by (keys, salt), numbered there, and shifted by the counts of the
    cell's smaller salts.  ``df`` is evaluated twice: pass a written table.
    ``keys`` hold no nulls.  Rows that tie in every ``order`` column are equal
    for the caller's purpose; they get different indexes.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    dealt = df.withColumn("_salt", salt)
    cells = dealt.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*keys, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "_salt").orderBy(*[F.col(c) for c in order])
    numbered = dealt.withColumn("_rn", F.row_number().over(within))
    return (numbered.join(offsets, [*keys, "_salt"])
            .withColumn(out, F.col("_before") + F.col("_rn") - 1)
            .drop("_salt", "_rn", "_before"))


def global_index(df: DataFrame, order: list[Column], out: str, name: str) -> tuple[DataFrame, int]:
    """Add ``out``: 0-based position of each row in the order of ``order`` over all rows; and their number.

    Range partitions are sorted, numbered locally and written; the shift of a
    partition is the sum of the counts before it (one row per partition).
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    return dense(stored(ranged, name), "_mid", out)


def dense(rows: DataFrame, mid: str, out: str) -> tuple[DataFrame, int]:
    """Replace ``mid`` (partition << 33 | place in the partition) by ``out``: 0, 1, 2, ... in its order; and their number."""
    part = F.shiftright(mid, 33).cast("int")
    shifts, total = [], 0
    # One row per partition of the job that wrote the rows.
    for p, n in sorted(rows.groupBy(part).count().collect()):
        shifts.append((p, total))
        total += n
    parts = rows.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    numbered = (rows.withColumn("_part", part).join(F.broadcast(parts), "_part")
                .withColumn(out, F.col("_shift") + F.col(mid).bitwiseAND(F.lit((1 << 33) - 1)))
                .drop("_part", "_shift", mid))
    return numbered, total

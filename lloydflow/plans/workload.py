"""The catalog's workload: point projections of the given tables and centre sets.

Point tables (x, y are INT; ``floor`` before the cast so Spark and DuckDB agree):
  L  lineitem  x = floor(l_extendedprice / 10), y = floor(l_quantity * 200)
  C  customer  x = floor(c_acctbal),            y = (c_custkey * 37) % 10000
  E  events    x = (user_id % 9) - 4,           y = floor(value)       (many x = -1)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import STABILITY_THRESHOLD
from ..sources.points import points_from

THRESHOLD = STABILITY_THRESHOLD

# Centre sets, in rank order.
K5 = [(1000, 1000), (2000, 8000), (5000, 5000), (8000, 2000), (9000, 9000)]
K5F = K5 + [(-90000, -90000)]  # the last centre stays empty
KDUP = [(1000, 1000), (1000, 1000), (8000, 8000)]
KE = [(-2, 10), (0, 100), (2, 300)]
KT = [(2, 250), (-2, 250)]  # every x = 0 point of E is equidistant: the first centre wins


def lattice(n: int, cols: int = 10, x0: int = -1000, dx: int = 1200, y0: int = 500, dy: int = 1800):
    """``n`` centres on a regular lattice (row-major) — a larger-k centre set by rule."""
    return [(x0 + (i % cols) * dx, y0 + (i // cols) * dy) for i in range(n)]


LATTICE_60 = lattice(60)
LATTICE_200 = lattice(200, cols=20, x0=-500, dx=560, y0=0, dy=1100)  # many centres: the pruning-grid path

# Many centres, one of them far from all others and without points.
LATTICE_1000F = [(-9_000_000, -9_000_000), *lattice(999, cols=40, x0=-500, dx=280, y0=0, dy=400)]
# Squared distances from small points to the first two differ, their roots do not: the first wins.
KROOT = [(134217728, 2), (134217728, 0), (-134217728, 5), (-134217728, 3)]
KROOT_44 = KROOT + [(134217728 + i, 1_000_000 + i) for i in range(40)]

POINTS_L_SQL = ("SELECT l_orderkey, l_linenumber, l_suppkey, CAST(floor(l_extendedprice / 10) AS INTEGER) AS x, "
                "CAST(floor(l_quantity * 200) AS INTEGER) AS y FROM lineitem")
POINTS_C_SQL = ("SELECT c_custkey, CAST(floor(c_acctbal) AS INTEGER) AS x, "
                "CAST((c_custkey * 37) % 10000 AS INTEGER) AS y FROM customer")
POINTS_S_SQL = ("SELECT c_custkey, CAST(c_custkey % 3 - 1 AS INTEGER) AS x, CAST(c_custkey % 7 AS INTEGER) AS y "
                "FROM customer")
# Above this many rows the queries keep their centres a table (also on the smallest tables).
MANY = 1000
# One centre per supplier.
CENTERS_S_SQL = ("SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INTEGER) AS rank, "
                 "CAST((s_suppkey * 7919) % 11000 AS INTEGER) AS x, CAST((s_suppkey * 104729) % 10100 AS INTEGER) AS y FROM supplier")
# One centre per order: more than ten thousand.
CENTERS_O_SQL = ("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS rank, CAST(floor(o_totalprice / 40) AS INTEGER) AS x, "
                 "CAST((o_orderkey * 53) % 10000 AS INTEGER) AS y FROM orders")
POINTS_E_SQL = ("SELECT event_id, CAST((user_id % 9) - 4 AS INTEGER) AS x, "
                "CAST(floor(value) AS INTEGER) AS y FROM events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def points_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return points_from(t, F.floor(F.col("l_extendedprice") / 10), F.floor(F.col("l_quantity") * 200),
                       keep=("l_orderkey", "l_linenumber", "l_suppkey"))


def points_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "customer")
    return points_from(t, F.floor(F.col("c_acctbal")), (F.col("c_custkey") * 37) % 10000, keep=("c_custkey",))


def points_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events")
    return points_from(t, (F.col("user_id") % 9) - 4, F.floor(F.col("value")), keep=("event_id",))


def points_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "customer")
    return points_from(t, F.col("c_custkey") % 3 - 1, F.col("c_custkey") % 7, keep=("c_custkey",))


def centers_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "supplier")
    return t.select(F.col("s_suppkey").alias("rank"), ((F.col("s_suppkey") * 7919) % 11000).cast("int").alias("x"),
                    ((F.col("s_suppkey") * 104729) % 10100).cast("int").alias("y"))


def centers_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders")
    return t.select(F.col("o_orderkey").alias("rank"), F.floor(F.col("o_totalprice") / 40).cast("int").alias("x"),
                    ((F.col("o_orderkey") * 53) % 10000).cast("int").alias("y"))

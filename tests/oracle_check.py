"""Run catalog queries in Spark and their oracle SQL in DuckDB, and compare.

Comparison mirrors the driver's: same row count, same column names, and the
same multiset of rows once columns are put in name order.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v) if not v.is_integer() else int(v) if abs(v) < 2**53 else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records], sorted(columns)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def compare(spark, con, name, query_fn, sql, sf_dir):
    t0 = time.perf_counter()
    df = query_fn(spark, sf_dir)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.perf_counter()
    rel = con.sql(sql)
    o_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(sql)
    o_cols = [c[0] for c in res.description]
    o_rows = res.fetchall()
    t2 = time.perf_counter()
    srows, scols = rows_of(s_cols, s_rows)
    orows, ocols = rows_of(o_cols, o_rows)
    problems = []
    if scols != ocols:
        problems.append(f"columns differ: spark={scols} oracle={ocols}")
    elif s_types != o_types:
        problems.append(f"types differ: spark={s_types} oracle={o_types}")
    if len(srows) != len(orows):
        problems.append(f"row count differs: spark={len(srows)} oracle={len(orows)}")
    elif Counter(srows) != Counter(orows):
        diff_s = list((Counter(srows) - Counter(orows)).elements())[:3]
        diff_o = list((Counter(orows) - Counter(srows)).elements())[:3]
        problems.append(f"values differ: spark-only={diff_s} oracle-only={diff_o}")
    return {"name": name, "ok": not problems, "rows": len(srows), "spark_s": round(t1 - t0, 3),
            "oracle_s": round(t2 - t1, 3), "problems": problems}


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from lloydflow.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    q, o = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in q:
        if only and name not in only:
            continue
        if name not in o:
            print(f"-- {name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, q[name], o[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "problems": [f"{type(e).__name__}: {str(e)[:400]}"]}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + name, r.get("rows"), r.get("spark_s"), r.get("oracle_s"),
              "; ".join(r["problems"]), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

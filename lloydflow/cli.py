"""Command line with the reference programs' shape: ``VARIANT data centres outputPrefix [iterations]``.

Variants (one per reference program family):

  plain      fixed rounds, plain aggregation           (outputs prefix1 … prefixR)
  stop-any   plain, stop after the first round ≥ 2 with a stable centre
  stop-all   plain, stop after the first round with every centre stable
  combined   fixed rounds, partial (combiner) aggregation
  status     combined, every output headed by its convergence status
  listing    combined, then every point with its final centre in prefixFinal

``data`` is a file, directory or glob of ``x,y[,…]`` lines; ``centres`` a file of
``x,y`` / ``x<TAB>y`` lines.  Prints the elapsed seconds, as the reference does.
Run with ``spark-submit lloydflow/cli.py …`` or ``python -m lloydflow …``.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from .plans.lloyd import fit
from .sources.centers import read_centers
from .sources.points import read_points

VARIANTS = {
    "plain": {"mode": "plain", "stop": "none"},
    "stop-any": {"mode": "plain", "stop": "any"},
    "stop-all": {"mode": "plain", "stop": "all"},
    "combined": {"mode": "combined", "stop": "none"},
    "status": {"mode": "combined", "stop": "none", "status_files": True},
    "listing": {"mode": "combined", "stop": "none", "final_listing": True},
}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="lloydflow", description=__doc__.split("\n\n")[0])
    p.add_argument("variant", choices=sorted(VARIANTS))
    p.add_argument("data")
    p.add_argument("centres")
    p.add_argument("output_prefix")
    p.add_argument("iterations", nargs="?", type=int, default=1)
    p.add_argument("--persist", choices=["cache", "table", "none"], default="cache")
    p.add_argument("--collapse", action="store_true", help="merge equal points into weights first (exact)")
    p.add_argument("--resume", action="store_true", help="continue after the last round already written")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> float:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    started = time.time()
    spark = spark or SparkSession.builder.appName(f"lloydflow-{args.variant}").getOrCreate()
    centres = read_centers(spark, args.centres)
    persist = {"cache": True, "table": "table", "none": False}[args.persist]
    fit(read_points(spark, args.data), centres, iterations=args.iterations, output_prefix=args.output_prefix,
        persist=persist, collapse=args.collapse, resume=args.resume, **VARIANTS[args.variant])
    seconds = time.time() - started
    print(f"{seconds} seconds")
    return seconds


if __name__ == "__main__":
    main()

"""Command line: cluster the posting lines at PATH and print the report.

    python -m tagmeans PATH [--spread 50000] [--kernels 45] [--eta 20]
                            [--max-iterations 120] [--langs A,B,...]
                            [--sample FRACTION] [--lenient] [--id-type int|bigint]
                            [--master URL]

Under spark-submit the session settings (master, checkpoint folder, ...)
come from the submit command; ``--master`` is for a quick local run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import DEFAULT_ETA, DEFAULT_KERNELS, DEFAULT_LANG_SPREAD, DEFAULT_MAX_ITERATIONS
from .config import ClusterConfig
from .plans.clustering import run_lines
from .sources.sinks import print_report
from .sources.text import read_lines


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tagmeans", description=__doc__.splitlines()[0])
    ap.add_argument("path", nargs="+", help="posting text files (any Spark-readable path)")
    ap.add_argument("--spread", type=int, default=DEFAULT_LANG_SPREAD,
                    help="x distance between languages (>= 500: seeds per language)")
    ap.add_argument("--kernels", type=int, default=DEFAULT_KERNELS,
                    help="number of clusters, a multiple of the language count")
    ap.add_argument("--eta", type=float, default=DEFAULT_ETA,
                    help="stop when the summed squared center movement is below this")
    ap.add_argument("--max-iterations", type=int, default=DEFAULT_MAX_ITERATIONS,
                    help="at most this many k-means updates")
    ap.add_argument("--langs", help="comma-separated language list (order = index)")
    ap.add_argument("--seed", type=int, default=42, help="seed of the seed-point draw")
    ap.add_argument("--sample", type=float, help="Poisson down-sample of scored questions")
    ap.add_argument("--lenient", action="store_true", help="drop malformed lines")
    ap.add_argument("--id-type", choices=("int", "bigint"), default="int",
                    help="type of posting ids: 32 bits, or 64 bits")
    ap.add_argument("--drop-unknown", action="store_true", help="drop unknown tags")
    ap.add_argument("--master", help="Spark master for a local run, e.g. local[*]")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("tagmeans")
    if args.master:
        # A quick run outside spark-submit: no web UI server.
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    kw = {}
    if args.langs:
        kw["langs"] = tuple(s for s in args.langs.split(","))
    config = ClusterConfig(lang_spread=args.spread, kernels=args.kernels, eta=args.eta,
                           max_iterations=args.max_iterations, seed=args.seed,
                           on_unknown="drop" if args.drop_unknown else "error", **kw)
    run = run_lines(read_lines(spark, args.path), config, strict=not args.lenient,
                    sample_fraction=args.sample, id_type=args.id_type)
    print(f"k-means: {run.result.updates} updates, converged={run.result.converged}")
    print_report(run.stats())


if __name__ == "__main__":
    main()

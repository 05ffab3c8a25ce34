"""Benchmark: the clustering pipeline and its heavy operators.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
``{"metric": "end_to_end_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

``value`` is the wall clock of the whole pipeline (the reference's main):
text lines -> postings -> scored points -> seeds -> k-means -> results. The
posting lines are derived from the star tables and written once as a text
table (not timed), so the timed pipeline starts from a real text scan, as
the reference does. ``queries`` also times its phases, the same pipeline
fed straight from the tables (``end_to_end_from_tables``), and the standalone
operators. A short warm-up on sf0.001 runs first so JVM start and code
generation are not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _session(cpus: int) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]")
            .appName("tagmeans-bench")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.driver.memory", "16g")
            .getOrCreate())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = _session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    from tagmeans.operators.counts import stage_counts
    from tagmeans.operators.kmeans import kmeans
    from tagmeans.operators.parse import malformed_lines, parse_postings
    from tagmeans.operators.sampling import draw_centers
    from tagmeans.plans.checkpoint import write_copy
    from tagmeans.plans.clustering import prepare_points, run_lines
    from tagmeans.plans.queries import CFG, CFG_MIXED
    from tagmeans.operators.scoring import grouped_postings, scored_vectors
    from tagmeans.sources.star import star_lines
    from tagmeans.sources.text import read_lines
    from tagmeans.operators.parse import answers, questions
    from tagmeans.operators.scoring import qa_pairs

    # Warm-up on the smallest tables (not timed).
    run_lines(star_lines(spark, "/root/testdata/sf0.001"), CFG).results().collect()

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    text_dir = os.path.join(tempfile.mkdtemp(prefix="tagmeans-bench-"), "lines")
    star_lines(spark, sf_dir).repartition(cpus).write.text(text_dir)
    lines = read_lines(spark, text_dir)

    # The whole pipeline, with its phases.
    t_all = time.perf_counter()
    vectors, _ = timed("score_vectors", lambda: write_copy(
        scored_vectors(parse_postings(lines), CFG)))
    weighted = timed("weighted_points", lambda: prepare_points(vectors))
    seeds = timed("seeds", lambda: draw_centers(vectors, CFG))
    result = timed("kmeans", lambda: kmeans(weighted, seeds, CFG))
    from tagmeans.operators.summary import cluster_results
    timed("cluster_results", lambda: cluster_results(weighted, result.centers, CFG).collect())
    total = round(time.perf_counter() - t_all, 3)
    times["end_to_end"] = total
    times["kmeans_updates"] = result.updates
    times["kmeans_sec_per_update"] = round(times["kmeans"] / max(1, result.updates), 3)

    # The same pipeline fed straight from the star tables.
    t0 = time.perf_counter()
    run_lines(star_lines(spark, sf_dir), CFG).results().collect()
    times["end_to_end_from_tables"] = round(time.perf_counter() - t0, 3)

    # The mixed-language setting (spread 100, global seeds).
    t0 = time.perf_counter()
    run = run_lines(lines, CFG_MIXED)
    run.results().collect()
    times["end_to_end_mixed"] = round(time.perf_counter() - t0, 3)
    times["kmeans_mixed_updates"] = run.result.updates

    # Standalone operators over the whole tables.
    timed("parse_postings", lambda: parse_postings(lines).agg(
        F.count("posting_type"), F.count("tags")).collect())
    timed("malformed_lines", lambda: malformed_lines(lines).count())
    timed("grouped_postings", lambda: grouped_postings(parse_postings(lines)).agg(
        F.sum("n_pairs"), F.count("question")).collect())
    timed("qa_pairs", lambda: qa_pairs(questions(parse_postings(lines)),
                                       answers(parse_postings(lines))).agg(
        F.count("answer")).collect())
    timed("stage_counts", lambda: stage_counts(lines, CFG).collect())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "end_to_end_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

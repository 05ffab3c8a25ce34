"""Print skeletons of the physical plans of the main operators.

Usage: python tools/plan_report.py [sf_dir]

The posting lines of the star tables are written once as text into a fresh
temporary folder and read back with the text reader, so the plans start from
a real text scan. Each skeleton keeps the operator names, the exchange kind
and whether an aggregate or group limit is the partial (map-side) step.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def skeleton(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    out = []
    for ln in buf.getvalue().splitlines():
        m = re.match(r"^([ :|+\-]*)(\*\(\d+\) )?([A-Za-z]+)(.*)", ln)
        if not m or m.group(3) in ("Physical", "AdaptiveSparkPlan"):
            continue
        node, extra = m.group(3), ""
        if node == "Exchange":
            extra = (" hashpartitioning" if "hashpartitioning" in ln
                     else " SinglePartition" if "SinglePartition" in ln else "")
        elif node in ("HashAggregate", "SortAggregate", "ObjectHashAggregate"):
            extra = " (partial)" if "partial_" in ln else ""
        elif node == "WindowGroupLimit":
            extra = " (Partial)" if "Partial" in ln else " (Final)"
        out.append(m.group(1) + node + extra)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tagmeans import (cluster_stats, draw_centers, grouped_postings, parse_postings,
                          read_lines, sample_stratified, scored_vectors, stage_counts,
                          star_lines, weighted_points)
    from tagmeans.operators.kmeans import cluster_sums
    from tagmeans.plans.checkpoint import cut_lineage
    from tagmeans.plans.clustering import prepare_points
    from tagmeans.plans.queries import CFG

    path = os.path.join(tempfile.mkdtemp(prefix="tagmeans-plans-"), "lines")
    star_lines(spark, sf_dir).write.text(path)
    lines = read_lines(spark, path)
    vectors = cut_lineage(scored_vectors(parse_postings(lines), CFG))
    weighted = prepare_points(vectors)
    seeds = draw_centers(vectors, CFG)
    plans = [
        ("scored_vectors (scan -> parse -> per-question aggregate)",
         scored_vectors(parse_postings(lines), CFG)),
        ("weighted_points", weighted_points(vectors)),
        ("stratified seed draw", sample_stratified(vectors, CFG)),
        ("k-means update", cluster_sums(weighted, seeds)),
        ("cluster_stats", cluster_stats(weighted, seeds, CFG)),
        ("stage_counts", stage_counts(lines, CFG)),
        ("grouped_postings", grouped_postings(parse_postings(lines))),
    ]
    for name, df in plans:
        print(f"### {name}\n{skeleton(df)}\n")
    spark.stop()


if __name__ == "__main__":
    main()

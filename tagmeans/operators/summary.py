"""Per-cluster summary (W1 with A5-A8) and its ordering (K4).

Works on the weighted point set ``(x, y, n)`` (or on plain points, weight
1). Every point is assigned once; one aggregate per cluster, partial before
its shuffle, gives the size, the sizes by language and the exact median. The
median is Spark's exact ``percentile`` with the multiplicity as frequency,
whose buffer holds one entry per distinct score of the cluster, never the
cluster's points. The plan has one sum for each language of the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..functions.expressions import lang_label, median_int
from .kmeans import Centers, _weight, assign_closest


def cluster_stats(points: DataFrame, centers: Centers, config: ClusterConfig) -> DataFrame:
    """Per non-empty cluster: ``i, lang_idx, lang_label, lang_percent,
    cluster_size, median_score`` (unordered)."""
    lang = (F.col("x") / F.lit(config.lang_spread)).cast("int")
    a = assign_closest(points, centers).select(
        "i", lang.alias("lang"), F.col("y").cast("long").alias("y"), _weight(points).alias("n"))
    # One aggregate, so every point is assigned once: A7 and A8 of the cluster, and
    # its size in each language of the list (as many sums as there are languages).
    per_lang = [F.coalesce(F.sum(F.when(F.col("lang") == k, F.col("n"))), F.lit(0)).alias(f"c{k}")
                for k in range(len(config.langs))]
    sums = a.groupBy("i").agg(F.sum("n").alias("cluster_size"),
                              median_int("y", "n").alias("median_score"), *per_lang)
    # A5: most frequent language; ties -> lowest language index.
    top = F.array_max(F.array(*[F.struct(F.col(f"c{k}").alias("c"), F.lit(-k).alias("neg"))
                                for k in range(len(config.langs))]))
    named = sums.select("i", "cluster_size", "median_score", top.alias("top"))
    lang_idx = (-F.col("top.neg")).cast("int")
    return named.select("i", lang_idx.alias("lang_idx"),
                        lang_label(lang_idx, config.langs).alias("lang_label"),
                        # A6: share of the dominant language, unrounded double.
                        (F.col("top.c").cast("double") * F.lit(100.0)
                         / F.col("cluster_size").cast("double")).alias("lang_percent"),
                        "cluster_size", "median_score")


def cluster_results(points: DataFrame, centers: Centers, config: ClusterConfig) -> DataFrame:
    """W1 + K4: ``lang_label, lang_percent, cluster_size, median_score`` for
    every non-empty cluster, ascending by median score (then language index,
    then cluster index, so ties are fixed)."""
    return (cluster_stats(points, centers, config)
            .orderBy("median_score", "lang_idx", "i")
            .select("lang_label", "lang_percent", "cluster_size", "median_score"))

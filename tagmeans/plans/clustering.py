"""End-to-end plan: lines -> postings -> scored questions -> points ->
seeds -> k-means -> cluster results.

Spark work per run: one lazy plan from the scan to the per-question points,
written once as Parquet in the checkpoint folder (it feeds both the seed draw
and the weighted points, which read two of its columns); the weighted points ``(x, y, n)`` are written, re-split
and cached (every k-means update re-reads them); then one small job for the
number of points, one for the seeds, one per update and one for the
summary. Only the seeds and centers (k rows) and the
summary (at most k rows) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..config import ClusterConfig
from ..operators.kmeans import Centers, KMeansResult, kmeans
from ..operators.parse import parse_postings
from ..operators.sampling import draw_centers, sample_rows
from ..operators.scoring import grouped_postings, scored_languages, scored_postings
from ..operators.summary import cluster_results, cluster_stats
from ..operators.vectors import language_points, weighted_points
from ..sources.sinks import report_lines
from .checkpoint import cut_lineage, delete_copy, write_copy


def score(postings: DataFrame, strict: bool = True, langs=None) -> DataFrame:
    """Postings -> scored questions (A1-A3 on the question-id key). ``langs``
    decides between duplicates of a question (see ``grouped_postings``)."""
    return scored_postings(grouped_postings(postings, strict=strict, langs=langs))


def vectors_from_postings(postings: DataFrame, config: ClusterConfig, strict: bool = True,
                          sample_fraction: float | None = None,
                          sample_seed: int = 0) -> DataFrame:
    """Postings -> per-question points ``id, x, high_score`` (lazy), through
    one aggregation.

    ``sample_fraction`` applies the reference's optional Poisson down-sample
    (K3) to the scored questions, before unknown tags raise or are dropped: a
    tag outside the sample is no error.
    """
    scored = scored_languages(postings, config, strict=strict)
    if sample_fraction is not None:
        scored = sample_rows(scored, sample_fraction, sample_seed)
    return language_points(scored, config)


# Points per partition of the k-means input: every update evaluates k
# distances per point, so this bounds the work of one task.
POINTS_PER_TASK = 1024


def prepare_points(vectors: DataFrame) -> DataFrame:
    """Weighted points, written to the checkpoint folder, re-split and cached.

    The weighted set is small, so Spark packs it into few partitions; every
    k-means update would then run in a single task. The written copy is
    re-split by ``(x, y)`` into about ``POINTS_PER_TASK`` points per
    partition (at most one partition per core) and cached; a lost cached
    block is rebuilt from the written copy through that one small shuffle.
    The caller unpersists it.
    """
    spark = vectors.sparkSession
    weighted = cut_lineage(weighted_points(vectors))
    target = min(spark.sparkContext.defaultParallelism, max(1, -(-weighted.count() // POINTS_PER_TASK)))
    if weighted.rdd.getNumPartitions() != target:
        weighted = weighted.repartition(target, "x", "y")
    weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
    weighted.count()  # fill the cache before the first update
    return weighted


@dataclass
class ClusterRun:
    config: ClusterConfig
    vectors: DataFrame
    weighted: DataFrame
    seeds: Centers
    result: KMeansResult
    path: str | None = None

    @property
    def means(self) -> Centers:
        return self.result.centers

    def stats(self) -> DataFrame:
        return cluster_stats(self.weighted, self.means, self.config)

    def results(self) -> DataFrame:
        return cluster_results(self.weighted, self.means, self.config)

    def report(self) -> DataFrame:
        return report_lines(self.stats())

    def release(self) -> None:
        """Drop the cached weighted points and the written per-question points."""
        self.weighted.unpersist()
        if self.path:
            delete_copy(self.weighted.sparkSession, self.path)
            self.path = None


def cluster_vectors(vectors: DataFrame, config: ClusterConfig,
                    seeds: Centers | None = None) -> ClusterRun:
    """Seeds (unless given), k-means and the handles for the summary."""
    vectors, path = write_copy(vectors)
    weighted = prepare_points(vectors)
    if seeds is None:
        seeds = draw_centers(vectors, config)
    result = kmeans(weighted, seeds, config)
    return ClusterRun(config, vectors, weighted, seeds, result, path)


def run_postings(postings: DataFrame, config: ClusterConfig, strict: bool = True,
                 sample_fraction: float | None = None) -> ClusterRun:
    return cluster_vectors(
        vectors_from_postings(postings, config, strict, sample_fraction), config)


def run_lines(lines: DataFrame, config: ClusterConfig, strict: bool = True,
              sample_fraction: float | None = None, id_type: str = "int") -> ClusterRun:
    """The reference's main: text lines in, cluster run out. ``id_type='bigint'`` reads ids of 64 bits."""
    return run_postings(parse_postings(lines, strict=strict, id_type=id_type), config, strict, sample_fraction)

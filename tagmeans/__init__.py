"""tagmeans: question/answer posting clustering as Spark DataFrame operators.

Public surface (all DataFrame in, DataFrame out unless noted):

* sources: ``read_lines``, ``as_lines``; star-table adapter ``star_lines``,
  ``star_postings``; sink ``report_lines``
* parsing: ``parse_postings``, ``malformed_lines``, ``questions``, ``answers``
* scoring: ``qa_pairs``, ``grouped_postings``, ``scored_postings``,
  ``scored_vectors`` (the fused scoring + vectorizing aggregation)
* points: ``with_lang_index``, ``vector_postings``, ``weighted_points``
* seeds: ``sample_stratified``, ``sample_global``, ``sample_vectors``,
  ``draw_centers`` (k rows to the driver), ``sample_rows``
* k-means: ``assign_closest``, ``kmeans_step``, ``update_centers``,
  ``movement``, ``converged``, ``kmeans``
* summary: ``cluster_stats``, ``cluster_results``, ``stage_counts``
* plans: ``run_lines``, ``run_postings``, ``cluster_vectors``, ``prepare_points``
"""

from .config import ClusterConfig, DEFAULT_LANGS
from .operators.counts import stage_counts
from .operators.kmeans import (KMeansResult, assign_closest, converged, kmeans, kmeans_step,
                               movement, update_centers)
from .operators.parse import answers, malformed_lines, parse_postings, questions
from .operators.sampling import (draw_centers, sample_global, sample_rows, sample_stratified,
                                 sample_vectors)
from .operators.scoring import grouped_postings, qa_pairs, scored_postings, scored_vectors
from .operators.summary import cluster_results, cluster_stats
from .operators.vectors import vector_postings, weighted_points, with_lang_index
from .plans.clustering import (ClusterRun, cluster_vectors, prepare_points, run_lines,
                               run_postings)
from .sources.sinks import print_report, report_lines
from .sources.star import star_config, star_lines, star_postings
from .sources.text import as_lines, read_lines

__all__ = [
    "ClusterConfig", "DEFAULT_LANGS", "KMeansResult", "ClusterRun",
    "read_lines", "as_lines", "star_lines", "star_postings", "star_config",
    "report_lines", "print_report",
    "parse_postings", "malformed_lines", "questions", "answers",
    "qa_pairs", "grouped_postings", "scored_postings", "scored_vectors",
    "with_lang_index", "vector_postings", "weighted_points",
    "sample_stratified", "sample_global", "sample_vectors", "draw_centers", "sample_rows",
    "assign_closest", "kmeans_step", "update_centers", "movement", "converged", "kmeans",
    "cluster_stats", "cluster_results", "stage_counts",
    "run_lines", "run_postings", "cluster_vectors", "prepare_points",
]

"""Row counts at each stage (S3), as data instead of console prints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..functions.expressions import lang_index
from .parse import parse_postings
from .scoring import question_key

STAGES = ("lines", "postings", "questions", "answers", "qa_pairs", "scored", "vectors",
          "weighted_points")


def stage_counts(lines: DataFrame, config: ClusterConfig, strict: bool = True) -> DataFrame:
    """``stage string, n bigint`` for lines, postings, questions, answers,
    qa_pairs, scored, vectors and weighted_points.

    One parse and one aggregate per question id feed every count: the
    posting-level counts are sums of the per-id counts, pairs are
    ``sum(nq * na)`` and the weighted points a distinct count, all in one
    aggregate over the per-id rows, so the whole count is one scan. The strict checks
    of every stage still run, and an unknown tag fails the count of vectors
    as it fails the vectors themselves (``on_unknown='error'``).
    """
    postings = parse_postings(lines, strict=strict)
    is_q = F.col("posting_type") == 1
    is_a = F.col("posting_type") == 2
    code = F.when(is_q, F.coalesce(lang_index("tags", config.langs), F.lit(-1)))
    per_id = (postings.groupBy(question_key(strict).alias("qid"))
              .agg(F.count("posting_type").alias("np"),
                   F.count_if(is_q).alias("nq"),
                   F.count_if(is_a).alias("na"),
                   F.min(code).alias("lang_idx"),
                   F.max(F.when(is_a, F.col("score"))).alias("hs")))
    scored = (F.col("nq") > 0) & (F.col("na") > 0)
    known = F.col("lang_idx") >= 0
    if config.on_unknown == "error":
        vector = F.when(scored & ~known, F.raise_error(F.concat(
            F.lit("tag not in the language list for question id="),
            F.col("qid").cast("string"))).cast("boolean")).otherwise(scored)
    else:
        vector = scored & known
    point = F.struct(F.col("lang_idx"), F.greatest(F.col("hs"), F.lit(0)))
    totals = per_id.agg(
        F.sum("np").alias("postings"),
        F.sum("nq").alias("questions"),
        F.sum("na").alias("answers"),
        F.coalesce(F.sum(F.when(scored, F.col("nq") * F.col("na"))), F.lit(0)).alias("qa_pairs"),
        F.count_if(scored).alias("scored"),
        F.count_if(vector).alias("vectors"),
        F.count_distinct(F.when(vector, point)).alias("weighted_points"))
    # Strict parsing fails on any line it cannot turn into a posting, so there
    # every line is a posting; lenient parsing needs its own count of lines.
    line_count = F.col("postings") if strict else F.lit(None)
    out = totals.select(F.inline(F.array(
        F.struct(F.lit("lines").alias("stage"), line_count.cast("long").alias("n")),
        *[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("n"))
          for s in STAGES[1:]])))
    if strict:
        return out
    n_lines = lines.agg(F.count(F.lit(1)).cast("long").alias("n_lines"))
    return out.where(F.col("stage") != "lines").unionByName(
        n_lines.select(F.lit("lines").alias("stage"), F.col("n_lines").alias("n")))

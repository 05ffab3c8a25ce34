"""Language index (P4), vectorization (P5) and the weighted point set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..functions.expressions import lang_index


def with_lang_index(df: DataFrame, langs, tags: str = "tags") -> DataFrame:
    """P4: add ``lang_idx int``, null for a null or unknown tag."""
    return df.withColumn("lang_idx", lang_index(tags, langs))


def vector_postings(scored: DataFrame, config: ClusterConfig) -> DataFrame:
    """P5: ``(lang_idx * lang_spread, high_score)`` per scored question.

    Output: ``id int, x bigint, high_score int``. The question id is kept as
    a unique key for the seeded sampler. A missing or unknown tag fails the
    job (``on_unknown='error'``, the reference behaviour) or drops the row
    (``on_unknown='drop'``).
    """
    indexed = scored.select("id", F.coalesce(lang_index("tags", config.langs), F.lit(-1)).alias("lang_idx"),
                            "high_score")
    return language_points(indexed, config)


def language_points(indexed: DataFrame, config: ClusterConfig) -> DataFrame:
    """Points of scored questions with a language index (-1: missing or
    unknown tag). ``on_unknown='error'`` raises in a filter, so no action and
    no choice of columns can leave the check out."""
    idx = F.col("lang_idx")
    known = idx >= 0
    if config.on_unknown == "error":
        known = F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("tag not in the language list for question id="),
            F.col("id").cast("string"))).cast("boolean"))
    return indexed.where(known).select(
        "id", (idx.cast("long") * F.lit(config.lang_spread)).alias("x"), "high_score")


def weighted_points(vectors: DataFrame, y: str = "high_score") -> DataFrame:
    """The point multiset as ``(x, y, n)``: one row per distinct point with
    its multiplicity. Exact for means, medians, counts and shares, and bounded
    by (#languages x #distinct scores) instead of the number of questions.
    Output: ``x bigint, y bigint, n bigint``.
    """
    return (vectors.groupBy(F.col("x").cast("long").alias("x"),
                            F.col(y).cast("long").alias("y"))
            .agg(F.count(F.lit(1)).alias("n")))

"""Question-answer join (J1), grouping (A1), scoring (A2/A3).

The reference joins questions to answers, groups the pairs per question id
and folds each group. A question and its answers share one key, the
question id (``id`` of a question, ``parent_id`` of an answer), so the join
plus grouping collapses into ONE aggregation over all postings keyed by that
id, with map-side partial aggregation: no join, one shuffle, and no filter
above the parser (a pushed-down filter would inline the parse expression).

Pair-level statistics follow exactly from per-side counts: a question id
present ``nq`` times with ``na`` answers yields ``nq * na`` pairs, each
answer repeated ``nq`` times. No per-question list is ever built, so a
question holding a third of all answers costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..functions.expressions import lang_index
from ..plans.checkpoint import cut_lineage
from ..schema import POSTING_COLUMNS
from .vectors import language_points


def _posting_struct() -> F.Column:
    return F.struct(*[F.col(c) for c in POSTING_COLUMNS])


def question_key(strict: bool = True) -> F.Column:
    """The question id a posting belongs to: its own id for a question, its
    parent for an answer, null for any other type. ``strict`` fails on an
    answer without a parent (the reference's ``parentId.get``)."""
    t = F.col("posting_type")
    parent = F.col("parent_id")
    if strict:
        parent = F.coalesce(parent, F.raise_error(F.concat(
            F.lit("answer without parent: id="), F.col("id").cast("string"))).cast("int"))
    return F.when(t == 1, F.col("id")).when(t == 2, parent)


def _is_q() -> F.Column:
    return F.col("posting_type") == 1


def _is_a() -> F.Column:
    return F.col("posting_type") == 2


#: An id that holds this share of all questions or answers is hot: there are at most 2 / HOT_SHARE of them.
HOT_SHARE = 0.001
#: Parts that the rows of a hot id are dealt to.
SALTS = 32


def splits_skew(spark: SparkSession) -> bool:
    """Whether the session splits skewed join partitions by itself."""
    on = lambda name: spark.conf.get(f"spark.sql.adaptive.{name}", "true").lower() == "true"
    return on("enabled") and on("skewJoin.enabled")


def qa_pairs(qs: DataFrame, ans: DataFrame, salted: bool | None = None) -> DataFrame:
    """J1: inner equi-join ``question.id = answer.parent_id``, one row per pair.

    Output: ``qid int, question struct<posting>, answer struct<posting>``.
    Unanswered questions and orphan answers vanish; duplicate question ids
    multiply. Catalyst/AQE pick the join strategy and split a skewed key.

    ``salted`` deals the rows of hot ids to ``SALTS`` parts on the side where they are hot and
    copies the other side's rows to each part; by default it is done where the session doesn't split
    skewed partitions itself. It costs one more read of both sides, to count them by id.
    """
    q = qs.select(F.col("id").alias("qid"), _posting_struct().alias("question"))
    a = ans.select(F.col("parent_id").alias("qid"), _posting_struct().alias("answer"))
    if salted is None:
        salted = not splits_skew(q.sparkSession)
    if not salted:
        return q.join(a, "qid", "inner")
    hot = _hot_ids(q, a)
    q = _salted(q, "question", hot, "q_parts", "a_parts", "q_part", "a_part")
    a = _salted(a, "answer", hot, "a_parts", "q_parts", "a_part", "q_part")
    return q.join(a, ["qid", "q_part", "a_part"], "inner").select("qid", "question", "answer")


def _hot_ids(q: DataFrame, a: DataFrame) -> DataFrame:
    """``qid, q_parts, a_parts`` of the ids that are hot on either side."""
    both = (q.select("qid", F.lit(1).alias("nq"), F.lit(0).alias("na"))
            .unionByName(a.select("qid", F.lit(0).alias("nq"), F.lit(1).alias("na"))))
    counts = (both.where("qid is not null").groupBy("qid").agg(F.sum("nq").alias("nq"), F.sum("na").alias("na"))
              .where("nq > 0 and na > 0"))  # ids without a partner make no pairs
    # ids of few rows are added up to one row (null), which only the totals need
    many = F.when(F.greatest("nq", "na") > SALTS, F.col("qid"))
    counts = cut_lineage(counts.groupBy(many.alias("qid")).agg(F.sum("nq").alias("nq"), F.sum("na").alias("na")))
    n = counts.agg(F.coalesce(F.sum("nq"), F.lit(0)).alias("q"), F.coalesce(F.sum("na"), F.lit(0)).alias("a")).first()
    parts = lambda c, total: F.when(F.col(c) > max(SALTS, HOT_SHARE * total), SALTS).otherwise(1)
    return (counts.select("qid", parts("nq", n.q).alias("q_parts"), parts("na", n.a).alias("a_parts"))
            .where("qid is not null and (q_parts > 1 or a_parts > 1)"))


def _salted(df: DataFrame, record: str, hot: DataFrame, own: str, other: str, part: str, copy: str) -> DataFrame:
    """``df`` with its own part of a hot id, by hash of the record, and a copy for each part of the other side."""
    parts = lambda c: F.coalesce(F.col(c), F.lit(1))
    return (df.join(F.broadcast(hot), "qid", "left")  # 2 / HOT_SHARE rows at most
            .withColumn(part, F.pmod(F.xxhash64(record), parts(own)))
            .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), parts(other).cast("long") - 1)))
            .drop(own, other))


def grouped_postings(postings: DataFrame, strict: bool = True, langs=None) -> DataFrame:
    """A1: one row per answered question id, summarizing its pairs.

    Output: ``qid int, question struct<posting>, n_pairs bigint,
    score_sum bigint, min_score int, max_score int``. Among duplicates of the
    id (the reference keeps an arbitrary one) ``question`` is the record with
    the smallest language index in ``langs``, a missing or unknown tag counting
    as smallest, then the smallest record; without ``langs`` the smallest
    record. With the language list of the vectorizer this is the rule of
    ``scored_vectors``. The pair lists themselves are not collected: an id
    with a third of all answers would otherwise have to fit one row.
    """
    code = F.lit(0) if langs is None else F.coalesce(lang_index("tags", langs), F.lit(-1))
    first = F.min(F.when(_is_q(), F.struct(code.alias("code"), _posting_struct().alias("question"))))
    g = (postings.groupBy(question_key(strict).alias("qid"))
         .agg(F.count_if(_is_q()).alias("nq"),
              first["question"].alias("question"),
              F.count_if(_is_a()).alias("na"),
              F.sum(F.when(_is_a(), F.col("score"))).alias("a_sum"),
              F.min(F.when(_is_a(), F.col("score"))).alias("min_score"),
              F.max(F.when(_is_a(), F.col("score"))).alias("max_score")))
    return (g.where((F.col("nq") > 0) & (F.col("na") > 0))
            .select("qid", "question",
                    (F.col("nq") * F.col("na")).alias("n_pairs"),
                    (F.col("nq") * F.col("a_sum")).alias("score_sum"),
                    "min_score", "max_score"))


def scored_postings(grouped: DataFrame) -> DataFrame:
    """A2 + A3: the question record of every answered question plus
    ``high_score`` = the best answer score, floored at 0.

    Output: posting columns of the question + ``high_score int``.
    """
    return grouped.select(*[F.col(f"question.{c}").alias(c) for c in POSTING_COLUMNS],
                          F.greatest(F.col("max_score"), F.lit(0)).alias("high_score"))


def scored_languages(postings: DataFrame, config: ClusterConfig, strict: bool = True) -> DataFrame:
    """A1-A3 fused with P4: ``id, lang_idx int, high_score int`` per answered
    question, straight from the postings; -1 for a missing or unknown tag.

    The question contributes only its language index, so every aggregate
    buffer is fixed-width and Spark runs a hash aggregate with a map-side
    partial step (no sort, no join, one shuffle of partial rows). Among
    duplicate question ids the smallest language index is kept.
    """
    code = F.when(_is_q(), F.coalesce(lang_index("tags", config.langs), F.lit(-1)))
    return (postings.groupBy(question_key(strict).alias("qid"))
            .agg(F.count_if(_is_q()).alias("nq"),
                 F.min(code).alias("lang_idx"),
                 F.count_if(_is_a()).alias("na"),
                 F.max(F.when(_is_a(), F.col("score"))).alias("hs"))
            .where((F.col("nq") > 0) & (F.col("na") > 0))
            .select(F.col("qid").alias("id"), "lang_idx",
                    F.greatest(F.col("hs"), F.lit(0)).alias("high_score")))


def scored_vectors(postings: DataFrame, config: ClusterConfig, strict: bool = True) -> DataFrame:
    """A1-A3 fused with P4/P5: ``id, x bigint, high_score int`` per answered
    question. An unknown tag fails the job (``on_unknown='error'``) or drops
    the question (``'drop'``)."""
    return language_points(scored_languages(postings, config, strict), config)

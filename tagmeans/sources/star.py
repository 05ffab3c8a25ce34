"""Adapter from the star-schema test tables to postings.

A question is an order (joined to its customer), an answer is a line item:

* question: type 1, ``id = o_orderkey``, score 0,
  ``tags = c_mktsegment || '-' || o_orderstatus``;
* answer: type 2, ``id = l_linenumber`` (nothing keys on an answer's id),
  ``parent_id = l_orderkey``,
  ``score = floor((l_extendedprice - 40000) / 100)``, no tag.

Text lines are ``type,id,,parent,score,tag`` with empty strings for nulls, so
answer lines end in a comma. Only the needed columns are read from parquet.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..schema import POSTING_COLUMNS

# Market segments and order statuses of the star tables. Their
# 15 combinations, sorted ascending, are the language list of the adapter.
STAR_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STAR_STATUSES = ("F", "O", "P")
STAR_TAGS: tuple[str, ...] = tuple(sorted(f"{s}-{t}" for s in STAR_SEGMENTS for t in STAR_STATUSES))


def star_config(**changes) -> ClusterConfig:
    """ClusterConfig with the adapter's 15 tags as the language list."""
    return ClusterConfig(langs=STAR_TAGS, **changes)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def star_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.lit(1).alias("posting_type"),
                    F.col("o_orderkey").cast("int").alias("id"),
                    F.lit(None).cast("int").alias("accepted_answer"),
                    F.lit(None).cast("int").alias("parent_id"),
                    F.lit(0).alias("score"),
                    F.concat_ws("-", "c_mktsegment", "o_orderstatus").alias("tags")))


def star_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    score = F.floor((F.col("l_extendedprice") - F.lit(40000.0)) / F.lit(100.0)).cast("int")
    return li.select(F.lit(2).alias("posting_type"),
                     F.col("l_linenumber").cast("int").alias("id"),
                     F.lit(None).cast("int").alias("accepted_answer"),
                     F.col("l_orderkey").cast("int").alias("parent_id"),
                     score.alias("score"),
                     F.lit(None).cast("string").alias("tags"))


def star_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers in the posting schema."""
    return star_questions(spark, sf_dir).unionByName(star_answers(spark, sf_dir)).select(
        *POSTING_COLUMNS)


def to_lines(postings: DataFrame) -> DataFrame:
    """Render postings as comma lines (``value string``); nulls become ''."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in POSTING_COLUMNS]
    return postings.select(F.concat_ws(",", *parts).alias("value"))


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting lines of the star tables."""
    return to_lines(star_postings(spark, sf_dir))

"""Training-data pipeline over ``documents``: five stages, each one operator.

Every stage is a function of (spark, docs, sf_dir) to a frame; it works on all
rows that the stage before kept. All but the last return the columns of
``documents``; the last writes the token files and returns, for each document
read back from them, ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagmeans.llm import decontamination, mixing, quality, simhash, token_output
from tagmeans.llm.common import table
from tagmeans.plans.checkpoint import delete_copy, write_copy


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, two bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark's windows to count as contaminated."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Clean documents at rate 1 and toxic ones at 0, each as often as its rate says."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, read back."""
    folder = token_output.new_folder(spark)
    token_output.write_tokens(docs, folder, token_output.default_path())
    return token_output.digest(token_output.read_tokens(spark, folder))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("token output", token_stage),
]

#: Trained scores and a tokenizer can't be written in SQL; tests/llm has the brute-force check.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each on a Parquet copy of what the one before
    kept, in the shared checkpoint folder; a copy goes when the next one is there."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs, path = stage(spark, docs, sf_dir), None
        if i < len(STAGES) - 1:
            docs, path = write_copy(docs)
        if before:  # the last stage reads its own files
            delete_copy(spark, before)
        before = path
    return docs

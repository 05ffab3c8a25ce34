"""Schemas of the posting record and of the operator outputs."""

from __future__ import annotations

from pyspark.sql import types as T

POSTING_COLUMNS = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")

POSTING = T.StructType([
    T.StructField("posting_type", T.IntegerType(), False),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("accepted_answer", T.IntegerType(), True),
    T.StructField("parent_id", T.IntegerType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tags", T.StringType(), True),
])

# Cluster centers: position ``i`` is the cluster id.
CENTERS = T.StructType([
    T.StructField("i", T.IntegerType(), False),
    T.StructField("x", T.LongType(), False),
    T.StructField("y", T.LongType(), False),
])

TRACE = T.StructType([
    T.StructField("iter", T.IntegerType(), False),
    T.StructField("i", T.IntegerType(), False),
    T.StructField("x", T.LongType(), False),
    T.StructField("y", T.LongType(), False),
    T.StructField("new_x", T.LongType(), False),
    T.StructField("new_y", T.LongType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("distance", T.DoubleType(), False),
    T.StructField("total_distance", T.DoubleType(), False),
    T.StructField("converged", T.BooleanType(), False),
])

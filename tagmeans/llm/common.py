"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.checkpoint import ensure_checkpoint_dir

#: Text bytes that a Python helper gets at once; a single longer text comes alone.
SLICE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this library where the driver has it
    (on a cluster it is installed, or shipped with ``--py-files``, as any library)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """``df`` from a copy in the cluster's shared checkpoint folder.

    A lost executor then costs a re-read of that copy. Spark's cleaner deletes
    the copy when the frame is no longer used, if it is told to.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def boxed(df: DataFrame, *extra) -> DataFrame:
    """All columns of ``df`` in one struct ``row``, so that no name can clash
    with those an operator adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *extra)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with at most ``limit`` characters or one row each."""
    begin, held = 0, 0
    for i, n in enumerate(pc.utf8_length(texts).fill_null(0).to_pylist()):
        if i > begin and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)


def add_from_text(df: DataFrame, text: str, schema: str,
                  make: Callable[[], Callable[[list[str]], list]],
                  columns: list[str] | None = None) -> DataFrame:
    """``row`` (all columns of ``df``, or ``columns``) and the columns of ``schema``.

    ``make()`` runs once in each task and gives the function from a list of
    texts (null: empty) to one Python list or Arrow array per new column.
    """
    box = boxed(df)
    if columns is not None:
        box = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`"))
    out = T.StructType([box.schema["row"], *T._parse_datatype_string(schema).fields])
    arrow = to_arrow_schema(out)
    column = df.columns.index(text)

    def run(batches):
        f = make()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(column) if columns is None else batch.column(1)
            for a, b in slices(texts):
                new = f([t or "" for t in texts.slice(a, b - a).to_pylist()])
                cols = [rows.slice(a, b - a).cast(arrow.field(0).type)]
                cols += [pa.array(x, type=arrow.field(i + 1).type) if not isinstance(x, pa.Array) else x
                         for i, x in enumerate(new)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return box.mapInArrow(run, out)


def labelled_sample(docs: DataFrame, marks: DataFrame, doc_id: str, text: str, sample: int, chars: int,
                    by_mark: bool = False) -> list:
    """At most ``sample`` rows (key, y, t) of documents with a mark (``key``, ``y``) and a text
    of at most ``chars`` characters, picked by hash of the id; of several texts of an
    id the least one. ``by_mark``: as many of each mark, as far as there are.

    Only ids are shuffled to pick the sample; its texts meet it in the scan."""
    short = F.length(F.coalesce(F.col(text), F.lit(""))) <= chars
    keys = docs.where(short & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("key"))
    picked = keys.join(marks, "key").groupBy("key").agg(F.min("y").alias("y"))
    if by_mark:
        each = max(1, sample // max(1, marks.select("y").distinct().count()))
        nth = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("key"), "key"))
        picked = picked.withColumn("nth", nth).where(F.col("nth") <= each).drop("nth")
    else:
        picked = picked.orderBy(F.xxhash64("key"), "key").limit(sample)
    return (docs.where(short).select(F.col(doc_id).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
            .join(F.broadcast(picked), "key")  # ``sample`` rows at most
            .groupBy("key").agg(F.min("y").alias("y"), F.min("t").alias("t"))
            .orderBy(F.xxhash64("key"), "key").collect())

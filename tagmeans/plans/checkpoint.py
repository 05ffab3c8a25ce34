"""Reliable lineage cuts in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session.

    Order: the SparkContext's folder, then ``spark.checkpoint.dir``. Only a
    local-mode session without either gets a fresh temporary folder (tests);
    on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tagmeans-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from that copy.

    Later jobs read the written copy, so a lost executor costs a re-read,
    not a rerun of the upstream plan. For small frames; Spark's cleaner
    deletes the copy with the frame if it is told to.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_copy(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` from a Parquet copy in the checkpoint folder, and the copy's path.

    For large frames: compressed, with column pruning and statistics for what
    reads it. The caller deletes it with ``delete_copy`` when it is done.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagmeans-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_copy(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

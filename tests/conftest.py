from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tagmeans.schema import POSTING  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .appName("tagmeans-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a private checkpoint folder when the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tagmeans-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(v,) for v in lines], "value string")
    return make


@pytest.fixture
def postings_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, POSTING)
    return make


@pytest.fixture
def points_df(spark):
    def make(points, weighted=False):
        if weighted:
            return spark.createDataFrame(points, "x bigint, y bigint, n bigint")
        return spark.createDataFrame(points, "x bigint, y bigint")
    return make

import pytest

from tagmeans.plans.checkpoint import cut_lineage, ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master = master
        self.dir = current
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current, conf)
        self.conf = _Conf(conf or {})


def test_uses_the_context_folder_first():
    s = _Session("yarn", current="hdfs:///ckpt/app-1")
    assert ensure_checkpoint_dir(s) == "hdfs:///ckpt/app-1"


def test_uses_the_session_setting():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_master_gets_a_private_folder():
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and "tagmeans-ckpt-" in d


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    out = cut_lineage(df.groupBy("k").count())
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        tuple(r) for r in df.groupBy("k").count().collect())
    assert spark.sparkContext.getCheckpointDir()

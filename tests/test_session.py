import pytest

from costlens.session import CheckpointDirError, checkpoint_dir, scratch_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, configured=None):
        self.master = master
        self._conf = _Conf(configured)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_cluster_without_shared_checkpoint_folder_is_an_error():
    with pytest.raises(CheckpointDirError):
        checkpoint_dir(_Session(_Context("yarn")))


def test_configured_folder_is_used_on_a_cluster():
    sc = _Context("spark://host:7077", "hdfs:///shared/ckpt")
    assert checkpoint_dir(_Session(sc)) == "hdfs:///shared/ckpt"


def test_local_mode_gets_a_temporary_folder():
    sc = _Context("local[4]")
    d = checkpoint_dir(_Session(sc))
    assert d and sc.dir == d


def test_scratch_folders_live_under_the_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base.rstrip("/")) and a != b

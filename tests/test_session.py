"""The shared working folder and the session profile."""

import pytest

from linepulse.session import cluster_conf, shared_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_shared_dir_reads_the_session_setting():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"


def test_shared_dir_never_falls_back_to_a_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://master:7077"))


def test_shared_dir_local_run_gets_its_own_folder():
    s = _Session("local[2]")
    root = shared_dir(s)
    assert s.conf.get("spark.checkpoint.dir") == root
    assert s.sparkContext.getCheckpointDir() == root


def test_cluster_profile_scales_with_cores():
    conf = cluster_conf(executors=1000, cores_per_executor=8)
    assert conf["spark.sql.shuffle.partitions"] == str(32_000)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"

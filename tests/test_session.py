import pytest

from adsentry.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master)
        self.conf = _Conf(conf)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn", {}))


def test_cluster_setting_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_fallback_only_when_unset():
    assert ensure_checkpoint_dir(_Session("local[4]", {}), fallback="/tmp/x") == "/tmp/x"
    s = _Session("local[4]", {"spark.checkpoint.dir": "/shared"})
    assert ensure_checkpoint_dir(s, fallback="/tmp/x") == "/shared"

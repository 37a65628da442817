"""Shared scratch folder: read from the session, never machine-local on a cluster."""

import pytest

from quayside.session import shared_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master, self._ckpt, self._conf = master, checkpoint, _Conf()

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_configured_folder_is_used_as_is():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"


def test_context_checkpoint_folder_is_used():
    assert shared_dir(_Session("yarn", checkpoint="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_cluster_without_setting_fails_instead_of_using_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))


def test_local_master_gets_a_temporary_folder():
    s = _Session("local[2]")
    path = shared_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path


def test_session_conf_restores_set_and_unset_values(spark):
    from quayside.session import session_conf
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    default_open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    with pytest.raises(RuntimeError):
        with session_conf(spark, {"spark.sql.shuffle.partitions": "3", "spark.sql.files.openCostInBytes": "1"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise RuntimeError("fails inside the block")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.files.openCostInBytes") == default_open_cost

import pytest

from practica.session import cluster_conf, shared_dir


class _Conf:
    def get(self, key, default=None):
        return default


class _Ctx:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Ctx(master)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(_Session("yarn"))


def test_cluster_conf_sizes_partitions_from_the_largest_shuffle():
    conf = cluster_conf(2 * 1024 ** 4)                     # 2 TiB of partial aggregates
    assert conf["spark.sql.shuffle.partitions"] == str(2 * 1024 ** 4 // (256 << 20))
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"

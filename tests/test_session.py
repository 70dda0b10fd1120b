"""The shared folder for checkpoints."""

import pytest

from basketry.session import checkpoint_root


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext, self.conf = _Context(master), conf or {}


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session(master))
    assert checkpoint_root(_Session(master, {"spark.checkpoint.dir": "hdfs://x/c"})) == "hdfs://x/c"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_mode_makes_its_own(master):
    assert checkpoint_root(_Session(master))

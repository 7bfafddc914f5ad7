from types import SimpleNamespace

import pytest

from contentloom.session import shared_folder


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: settings.get(name, default)),
        sparkContext=Context(master),
    )


def test_the_folder_of_the_cluster_is_used():
    named = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert shared_folder(session("spark://host", **named)) == "hdfs:///shared"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_a_local_session_needs_a_folder_too():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("local[2]"))
    local = session("local[2]")
    local.sparkContext.setCheckpointDir("/shared")
    assert shared_folder(local) == "/shared"

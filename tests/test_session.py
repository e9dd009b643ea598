from types import SimpleNamespace

import pytest

from stratalake.session import run_folder, shared_folder


class FakeSession:
    def __init__(self, master, folder=None):
        self.set_to = []
        self.conf = SimpleNamespace(get=lambda key, default=None: folder or default)
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: f"{self.set_to[-1]}/some-id" if self.set_to else None,
            setCheckpointDir=self.set_to.append,
        )


def test_the_cluster_names_the_folder():
    session = FakeSession("yarn", "hdfs:///shared/")
    assert shared_folder(session) == "hdfs:///shared"
    assert session.set_to == ["hdfs:///shared/"]


def test_no_folder_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("spark://host:7077"))


def test_a_local_session_makes_one_and_keeps_it():
    session = FakeSession("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.set_to[0]
    assert len(session.set_to) == 1


def test_runs_do_not_share_folders(spark):
    assert run_folder(spark, "a") != run_folder(spark, "a")

"""The folder for intermediate tables, in sessions with and without the setting."""

from types import SimpleNamespace

import pytest

from footfall.session import shared_dir


def fake(master: str, root: str | None = None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: root),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_named_folder_is_used():
    assert shared_dir(fake("spark://host:7077", "hdfs:///work"), "x").startswith("hdfs:///work/x-")


def test_local_session_gets_one_temporary_folder():
    session = fake("local[4]")
    first, second = shared_dir(session, "x"), shared_dir(session, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_the_setting_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake(master), "x")

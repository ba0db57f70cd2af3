"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from wakeline.session import shared_dir


def session(master, folder=None):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, default: folder))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_clusters_need_a_shared_folder(master):
    with pytest.raises(ValueError):
        shared_dir(session(master), "x")
    assert shared_dir(session(master, "/shared/"), "x").startswith("/shared/x-")


def test_local_sessions_may_use_a_folder_of_their_own():
    assert "/x-" in shared_dir(session("local[2]"), "x")

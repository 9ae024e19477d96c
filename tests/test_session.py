from __future__ import annotations

from types import SimpleNamespace

import pytest

from meterlake.session import scratch_dir


def session(master: str, shared: str | None):
    """As much of a session as the scratch folder looks at."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": shared}[key] or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_shared_folder_is_used():
    first, second = (scratch_dir(session("spark://host:7077", "/shared/"), "x") for _ in range(2))
    assert first.startswith("/shared/x-") and first != second


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_dir(session(master, None), "x")


def test_a_local_session_keeps_one_temporary_folder():
    first, second = (scratch_dir(session("local[2]", None), "x") for _ in range(2))
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]

"""Session helpers: shared scratch folder."""

from types import SimpleNamespace

import pytest

from reelstack.session import checkpoint_root, materialize, scratch_path, scratch_scope


def _fake_session(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default=None: configured)
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf,
                         setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=sc)


def test_cluster_without_shared_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_fake_session("yarn"))


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_scratch_scope_removes_its_folders(spark):
    import os
    with scratch_scope(spark):
        inner = materialize(spark.range(3), "x")
        assert inner.count() == 3
        folder = inner.inputFiles()[0].replace("file://", "").rsplit("/", 2)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    kept = materialize(spark.range(3), "y")
    assert kept.count() == 3


def test_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_fake_session("local-cluster[2,1,1024]"))

"""Scratch space: the session's shared checkpoint folder, never a local one on a cluster."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from hackney.session import CHECKPOINT_CONF, ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def _session(master, conf):
    ctx = SimpleNamespace(master=master, setCheckpointDir=lambda path: None)
    return SimpleNamespace(sparkContext=ctx, conf=_Conf(conf))


def test_cluster_uses_the_configured_shared_folder():
    s = _session("yarn", {CHECKPOINT_CONF: "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "c0").startswith("hdfs:///shared/ckpt/hackney/c0/")


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session("spark://master:7077", {}))


def test_local_master_gets_a_fresh_folder_once():
    s = _session("local[4]", {})
    first = ensure_checkpoint_dir(s)
    assert first and s.conf.get(CHECKPOINT_CONF) == first
    assert ensure_checkpoint_dir(s) == first
    assert scratch_path(s, "x") != scratch_path(s, "x")      # fresh per call

"""Session helpers: recommended settings and the shared checkpoint folder."""

import pytest

from statflow.session import RECOMMENDED_CONF, apply_recommended, ensure_checkpoint_dir

def test_apply_recommended_sets_what_was_not_submitted(spark, monkeypatch):
    from statflow import session

    submitted = next(iter(RECOMMENDED_CONF))
    monkeypatch.setattr(session, "RECOMMENDED_CONF", {submitted: "1", "spark.sql.statflow.test": "2"})
    apply_recommended(spark)
    assert spark.conf.get("spark.sql.statflow.test") == "2"
    assert spark.conf.get(submitted) == RECOMMENDED_CONF[submitted]


class _Ctx:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, d):
        self.dir = d


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    def __init__(self, master):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf()


def test_cluster_session_needs_a_shared_checkpoint_folder():
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"))
    local = _Session("local[4]")
    assert ensure_checkpoint_dir(local) == local.sparkContext.dir == "spark-warehouse/_checkpoints"

"""Shared folder resolution: the session's setting wins; a local fallback only when unset."""
from tillroll import session


class _Conf:
    def __init__(self, v):
        self.v = v

    def get(self, key, default=None):
        return self.v if key == "spark.checkpoint.dir" and self.v else default

    def set(self, key, value):  # a running session refuses core settings
        raise AssertionError("must not modify spark.checkpoint.dir at run time")


class _Ctx:
    master = "local[4]"

    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d + "/uuid"


class _Spark:
    def __init__(self, v):
        self.conf, self.sparkContext = _Conf(v), _Ctx()


def test_uses_cluster_setting():
    assert session.shared_dir(_Spark("hdfs://nn/shared/ckpt")) == "hdfs://nn/shared/ckpt"


def test_local_fallback_only_when_unset():
    s = _Spark(None)
    d = session.shared_dir(s)
    assert d.endswith("/uuid") and "tillroll-ckpt-" in d
    assert session.shared_dir(s) == d        # stable afterwards


def test_work_path_under_shared_dir():
    p = session.work_path(_Spark("hdfs://nn/ckpt/"), "streams", "x")
    assert p == "hdfs://nn/ckpt/streams/x"


def test_no_private_folder_on_a_cluster():
    import pytest
    s = _Spark(None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(s)

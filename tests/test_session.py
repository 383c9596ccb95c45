import pytest

from ledgerlake import session
from ledgerlake.session import CLUSTER_CONF, checkpoint_root, get_session, scratch_path


def test_checkpoint_root_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/x-")


def test_checkpoint_root_fallback_without_setting(spark, monkeypatch):
    """When the cluster names no folder, a private one is chosen once per
    session - without trying to change the (immutable) core config."""
    class NoDir:
        def __init__(self, real):
            self._real = real

        def get(self, key, default=None):
            return None if key == "spark.checkpoint.dir" else self._real.get(key, default)

    class Wrapped:
        def __init__(self, real, master):
            self.conf = NoDir(real.conf)
            self.sparkContext = type("SC", (), {"master": master,
                                                "getConf": lambda _self: NoDir(real.sparkContext.getConf()),
                                                "_jsc": real.sparkContext._jsc,
                                                "setCheckpointDir": lambda _self, d: None})()
    w = Wrapped(spark, "local[4]")
    first = session.checkpoint_root(w)
    assert first == session.checkpoint_root(w) and "ledgerlake-ckpt-" in first
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Wrapped(spark, "spark://host:7077"))


def test_get_session_reuses_the_active_session(spark):
    assert get_session() is spark
    assert CLUSTER_CONF["spark.sql.adaptive.enabled"] == "true"

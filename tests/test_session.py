from types import SimpleNamespace

import pytest

from pacecast.session import cluster_conf, scratch_path, shared_dir


def test_cluster_conf_scales_with_input_and_cores():
    assert cluster_conf(8, 10 << 20)["spark.sql.shuffle.partitions"] == "16"
    assert cluster_conf(100, 1 << 40)["spark.sql.shuffle.partitions"] == "2048"
    assert cluster_conf(8000, 100 << 40)["spark.sql.shuffle.partitions"] == "204800"
    assert cluster_conf(8, 0)["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_shared_dir_comes_from_the_session(spark):
    base = shared_dir(spark)
    assert base == shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))


def session_like(master, settings, checkpoint=None):
    conf = SimpleNamespace(get=lambda key, default: settings.get(key, default))
    return SimpleNamespace(sparkContext=SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint, getConf=lambda: conf))


def test_shared_dir_is_never_invented_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session_like(master, {}))
    assert shared_dir(session_like("yarn", {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
    assert shared_dir(session_like("yarn", {}, "hdfs://x/z")) == "hdfs://x/z"
    assert shared_dir(session_like("local[2]", {})) == shared_dir(session_like("local[2]", {}))

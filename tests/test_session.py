"""The shared checkpoint folder and run folders."""

from types import SimpleNamespace

import pytest

from ordercraft import session


def _spark(master, named=None):
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k, d: named),
        setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_spark(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_sessions_get_a_folder(master):
    assert "ordercraft-ckpt-" in session.ensure_checkpoint_dir(_spark(master))


def test_the_named_folder_is_used():
    assert session.ensure_checkpoint_dir(_spark("yarn", "hdfs:///shared")) == "hdfs:///shared"


def test_run_folder_is_removed(spark):
    with session.run_folder(spark) as root:
        df = session.materialize(spark.range(3), "x")
        assert df.count() == 3 and root.rsplit("/", 1)[1] in df.inputFiles()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

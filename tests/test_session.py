"""Checkpoint folder rules: the cluster's shared folder, a temp folder only for local masters."""

import os
import subprocess
import sys

import pytest

from tessera.session import checkpoint_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master = master
        self._dir = current
        self.set_to = None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self.set_to = d
        self._dir = d


class _Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf)


def test_existing_dir_is_used():
    assert checkpoint_dir(_Session("yarn", current="hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"


def test_configured_dir_is_registered():
    s = _Session("yarn", conf="s3a://bucket/ckpt")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.set_to == "s3a://bucket/ckpt"


def test_cluster_without_dir_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_local_without_dir_gets_temp_folder():
    s = _Session("local[2]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.set_to == d


def test_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("local-cluster[2,1,1024]"))


SUBMITTED = """
from tessera.session import build_session
s = build_session()
get = s.conf.get
print("GOT", s.sparkContext.master, get("spark.sql.shuffle.partitions"), get("spark.sql.adaptive.advisoryPartitionSizeInBytes"),
      get("spark.sql.session.timeZone"), get("spark.sql.adaptive.coalescePartitions.parallelismFirst"))
s.stop()
"""


@pytest.mark.parametrize("submitted,want", [
    ("--conf spark.sql.shuffle.partitions=77 --conf spark.sql.adaptive.advisoryPartitionSizeInBytes=64m "
     "--conf spark.sql.session.timeZone=Europe/Paris", "local[1] 77 64m Europe/Paris false"),
    ("", "local[1] 16384 256m UTC false")])
def test_submitted_values_win(submitted, want):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"--master local[1] --driver-memory 1g {submitted} pyspark-shell", "PYTHONPATH": root}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    out = subprocess.run([sys.executable, "-c", SUBMITTED], env=env, capture_output=True, text=True, timeout=120)
    assert f"GOT {want}" in out.stdout, out.stderr[-2000:]


def test_scratch_tables_are_cleared(spark):
    from tessera.operators.lloyd import materialize
    from tessera.session import clear_scratch
    clear_scratch(spark)
    df = materialize(spark.range(10), "t-clear")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 10 and os.path.isdir(path)
    assert clear_scratch(spark) == 1 and not os.path.isdir(path)
    assert clear_scratch(spark) == 0


def test_public_surface_imports():
    import tessera
    for name in tessera.__all__:
        assert callable(getattr(tessera, name)), name

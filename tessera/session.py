"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Set wherever the submitted configuration does not say otherwise.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# The same for settings that must be known when the session starts.
STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    # With it on, every pyspark.sql.functions call walks the Python stack and
    # makes extra JVM round trips: building a plan cost more than running it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Shuffle sizing on a cluster (a join of the largest tables shuffles terabytes):
# AQE can only merge shuffle partitions, never split them, so start with many
# and let it coalesce small shuffles to ~256 MB each.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
LOCAL_DRIVER_MEMORY = "4g"


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on, the UI off and UTC time.

    On a cluster, pass no master and let spark-submit decide; shuffles then
    start with 16,384 partitions that AQE coalesces. Every default yields to a
    value that was submitted (spark-submit, spark-defaults, PYSPARK_SUBMIT_ARGS):
    the running context's configuration is asked once it exists. Only arguments
    given here override it. ``driver_memory`` is the heap of a local master, the
    one setting that must be known before the JVM starts (else
    TESSERA_DRIVER_MEMORY, else 4g unless the environment submits one).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    running = SparkSession.getActiveSession()
    for key, value in STATIC_DEFAULTS.items():
        # Under spark-submit the JVM is up and has its own values for these.
        if running is None and key not in submitted and "PYSPARK_GATEWAY_PORT" not in os.environ:
            builder = builder.config(key, value)
    if master and master.startswith("local"):
        heap = driver_memory or os.environ.get("TESSERA_DRIVER_MEMORY")
        if heap or not re.search(r"driver[-.]memory", submitted):
            builder = builder.config("spark.driver.memory", heap or LOCAL_DRIVER_MEMORY)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = spark.sparkContext.getConf()
    for key, value in (DEFAULTS if master else DEFAULTS | CLUSTER_DEFAULTS).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it. Only a local master with none set (tests, the bench)
    gets a folder under the system temp folder, removed when Python exits; on a
    cluster (``local-cluster`` too) a machine-local folder would be invisible to
    the executors, so an unset setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables; ``clear_scratch`` removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Deletes what this application wrote to its scratch paths; returns how many there were.

    For between runs: frames that still read a scratch table cannot be read
    afterwards.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = 0
    for p in map(hadoop, paths):
        found += bool(p.getFileSystem(conf).delete(p, True))
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: lineage cut, survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_shipped: set[str] = set()


def in_tasks(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors' path, wherever they or the driver were started.

    The package is added to the session once, as a zip of its sources.
    """
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).parent
        if package.is_dir():  # else it came as an archive that Spark has shipped itself
            folder = tempfile.mkdtemp(prefix="tessera-code-")  # the driver serves it to executors while it runs
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            archive = f"{folder}/tessera-{uuid.uuid4().hex}.zip"
            with zipfile.ZipFile(archive, "w") as z:
                for source in sorted(package.rglob("*.py")):
                    z.write(source, source.relative_to(package.parent))
            sc.addPyFile(archive)
        _shipped.add(sc.applicationId)
    return df.mapInArrow(function, schema)
